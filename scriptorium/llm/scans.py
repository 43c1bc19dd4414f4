"""Repair of text from scanned pages (problem 7): lines labelled by a hidden Markov model, words by a lexicon.

Method.  Lines of hard-wrapped texts become symbols of layout features (shape of a page number, likeness to title,
author or another line of the text, length, case, closing mark, a page number beside it).  A hidden Markov model with
the states text, header and page number labels them; its emissions and transitions start from layout weights and are
counted again from the Viterbi labels of all texts until they stand still (hard EM, tables of bounded size).  Texts are
written once with their symbols, which all later steps read.  Text lines whose last word goes on in the
next text line are breaks.  A misread word is one that a few reversals of known character confusions turn into a
word that is many times as frequent in the whole corpus; lexicon, candidate words and their repairs are joined as
tables.  Paragraphs are put together without page furniture, with broken words joined and misread words repaired.

A text counts as scanned if it is hard-wrapped and shows page furniture, a broken word or a misread word.
"""

from __future__ import annotations

import difflib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import spread, write_table
from .canonical import canonical
from .shingles import fold

TEXT, HEADER, PAGE = range(3)
_PAGE_NO = re.compile(r"[\s\W_]*(?:(?:page|pag|p|folio|fol|f)[\s.:]*)?(?:\d{1,4}|[ivxlc]{1,7})(?:\s*(?:/|sur|de|of)\s*\d{1,4})?[\s\W_]*", re.I)
_SIDE_NO = re.compile(r"^\s*\d{1,4}\s{2,}\S|\S\s{2,}\d{1,4}\s*$")
_BROKEN = re.compile(r"[^\W\d_][-‐­¬]$")
_WORD = re.compile(r"[^\W_]+(?:(?:[!|]|(?<=e)')[^\W_]+)*")
_SPACED = re.compile(r"^(?:\S ){3,}")
# fixed values: characters as scanners read them, and as they were
CONFUSIONS = [("c", "e"), ("e", "c"), ("1", "i"), ("1", "l"), ("l", "1"), ("f", "t"), ("t", "f"), ("5", "s"), ("0", "o"), ("!", "i"), ("!", "l"), ("|", "l"), ("|", "i"), ("ri", "n"), ("n", "ri"), ("rn", "m"), ("m", "rn"), ("6", "é"), ("6", "b"), ("ii", "u"), ("u", "ii"), ("y", "v"), ("v", "y"), ("cl", "d"), ("d", "cl"), ("g", "q"), ("q", "g"), ("li", "h"), ("h", "li"), ("8", "b"), ("8", "ê"), ("e'", "é"), ("9", "g"), ("vv", "w"), ("l", "i"), ("i", "l")]
_AGAIN = str.maketrans("1l!|05c6y", "iiiioseev")
#: A repair must be this many times as frequent as what was read, and occur so often at least.
TIMES, LEAST = 8, 3
#: A longer run of letters is no word that could be misread.
LONGEST = 60
SYMBOLS = 3 * 2 * 2 * 2 * 2 * 2 * 2


def _squash(line: str) -> str:
    """Letters only, folded, with confusable ones made equal."""
    return re.sub(r"[^a-z]", "", fold(line.lower().replace("œ", "oe").translate(_AGAIN)))


def _like(line: str, names: list[difflib.SequenceMatcher]) -> bool:
    """Whether the line is, begins or nearly is one of the names, each the second sequence of a matcher."""
    if len(line) < 5:
        return False
    for m in names:
        if line == m.b or len(line) >= 8 and m.b.startswith(line):
            return True
        if 0.72 <= len(line) / len(m.b) <= 1.39:
            m.set_seq1(line)
            if m.quick_ratio() >= 0.84 and m.ratio() >= 0.84:
                return True
    return False


def symbols(lines: list[str], names: list[str]) -> np.ndarray:
    """Layout symbol of each line, -1 for blank ones."""
    names = [difflib.SequenceMatcher(None, "", x, False) for x in (_squash(canonical(n)) for n in names if n) if len(x) >= 5]
    full = sorted(len(x) for x in lines if x.strip())
    usual = full[int(len(full) * 0.7)] if full else 0
    squashed = [_squash(x) if x.strip() and len(x) < 1.3 * usual else "" for x in lines]
    again = Counter(s for s in squashed if len(s) >= 5)
    page = [bool(x.strip()) and bool(_PAGE_NO.fullmatch(x)) for x in lines]
    solid = [k for k, x in enumerate(lines) if x.strip()]
    beside = set()
    for a, b in zip(solid, solid[1:]):
        if page[a]:
            beside.add(b)
        if page[b]:
            beside.add(a)
    out = np.full(len(lines), -1, np.int64)
    for k in solid:
        x = lines[k]
        bare = x.strip()
        shape = 1 if page[k] else 2 if _SIDE_NO.search(x) else 0
        letters = [c for c in bare if c.isalpha()]
        flags = (_like(squashed[k], names), again[squashed[k]] > 1 and bool(squashed[k]), len(bare) < 0.75 * usual, bool(letters) and (all(c.isupper() for c in letters) or bool(_SPACED.match(bare))), bare[-1] in ".!?;:,»" or bool(_BROKEN.search(bare)), k in beside or k == solid[0])
        s = shape
        for f in flags:
            s = 2 * s + f
        out[k] = s
    return out


def first_emissions() -> np.ndarray:
    """Log weights ``[state, symbol]`` of layout features before anything is counted."""
    w = np.zeros((3, SYMBOLS))
    for s in range(SYMBOLS):
        end, upper, short, again, like = (s >> 1) & 1, (s >> 2) & 1, (s >> 3) & 1, (s >> 4) & 1, (s >> 5) & 1
        beside, shape = s & 1, s >> 6
        w[PAGE, s] = 3 + beside if shape == 1 else -30
        w[HEADER, s] = -6 + 5.5 * like + 2.5 * again + 2.5 * (shape == 2) * (like | again | upper | beside) + 1.5 * upper + 1.0 * short - 2.5 * end + 1.5 * beside - 20 * (shape == 1)
        w[TEXT, s] = 1.0 - 2.5 * (shape == 1) - 3.0 * like * (1 - end) - 1.0 * upper
    return w


_T = np.array([[0.92, 0.03, 0.05], [0.6, 0.002, 0.398], [0.6, 0.398, 0.002]])
#: Rounds of counting at most, and the share of moved counts below which the model stands.
ROUNDS, STILL = 10, 1e-3


class LineModel:
    """Log emissions ``[state, symbol]`` and log transitions ``[state, next state]``."""

    def __init__(self, emit: np.ndarray | None = None, step: np.ndarray | None = None):
        self.emit = first_emissions() if emit is None else emit
        self.step = np.log(_T) if step is None else step


def viterbi(syms: np.ndarray, model: LineModel) -> np.ndarray:
    """The most probable states of the lines; blank lines stay out of the chain and are text."""
    at = np.flatnonzero(syms >= 0)
    out = np.zeros(len(syms), np.int64)
    if not len(at):
        return out
    emit = model.emit[:, syms[at]].T.tolist()
    (t00, t01, t02), (t10, t11, t12), (t20, t21, t22) = model.step.tolist()
    a, b, c = (x + np.log(y) for x, y in zip(emit[0], (0.6, 0.3, 0.1)))
    back = []
    for e in emit[1:]:  # three states: plain numbers are faster than arrays of three
        x = max((a + t00, 0), (b + t10, -1), (c + t20, -2))
        y = max((a + t01, 0), (b + t11, -1), (c + t21, -2))
        z = max((a + t02, 0), (b + t12, -1), (c + t22, -2))
        back.append((-x[1], -y[1], -z[1]))
        a, b, c = x[0] + e[0], y[0] + e[1], z[0] + e[2]
    s = max((a, 0), (b, -1), (c, -2))[1] * -1
    states = [s]
    for k in range(len(back) - 1, -1, -1):
        s = back[k][s]
        states.append(s)
    out[at] = states[::-1]
    return out


_LINED = "id long, body string, symbols binary"


def _symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with the layout symbols of their lines, two bytes each."""
    for b in batches:
        out = []
        for body, names in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            out.append(symbols(body.split("\n"), [n for n in names or [] if n]).astype(np.int16).tobytes())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], names=["id", "body", "symbols"])


def _states(b: pa.RecordBatch, model: LineModel):
    """Identifier, lines and states of each text of a batch ``id, body, symbols``."""
    for i, body, syms in zip(*(b.column(k).to_pylist() for k in range(3))):
        yield i, body.split("\n"), viterbi(np.frombuffer(syms, np.int16).astype(np.int64), model)


def _count(model: LineModel, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Symbols by state (``next`` -1), and steps from state to state (``symbol`` -1)."""
    n, steps = np.zeros((3, SYMBOLS), np.int64), np.zeros((3, 3), np.int64)
    for b in batches:
        for x in b.column(0).to_pylist():
            syms = np.frombuffer(x, np.int16).astype(np.int64)
            syms = syms[syms >= 0]
            states = viterbi(syms, model)
            np.add.at(n, (states, syms), 1)
            np.add.at(steps, (states[:-1], states[1:]), 1)
    (s, k), (u, v) = n.nonzero(), steps.nonzero()
    none = np.full
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.r_[s, u].astype(np.int32)), pa.array(np.r_[k, none(len(u), -1)].astype(np.int32)), pa.array(np.r_[none(len(s), -1), v].astype(np.int32)), pa.array(np.r_[n[s, k], steps[u, v]])],
        names=["state", "symbol", "next", "n"],
    )


def line_model(lined: DataFrame) -> LineModel:
    """Emissions and transitions counted from the labels of all texts, again and again until the counts stand still.

    Both rest on the first weights, which keep rare symbols in their place.
    """
    first = first_emissions()
    prior = np.exp(first - first.max(1, keepdims=True))
    prior = 50 * prior / prior.sum(1, keepdims=True)
    model, before = LineModel(), None
    for _ in range(ROUNDS):
        n, steps = np.zeros((3, SYMBOLS)), np.zeros((3, 3))
        now = model
        for r in lined.select("symbols").mapInArrow(lambda it: _count(now, it), "state int, symbol int, next int, n long").groupBy("state", "symbol", "next").agg(F.sum("n").alias("n")).collect():
            if r.symbol >= 0:
                n[r.state, r.symbol] = r.n
            else:
                steps[r.state, r.next] = r.n
        if before is not None and np.abs(n - before).sum() <= STILL * max(n.sum(), 1):
            break
        before = n
        # emissions against the share of each symbol
        counted = np.log((n + prior) / (n + prior).sum(1, keepdims=True))
        steps += 500 * _T
        model = LineModel(0.5 * (counted - counted.max(1, keepdims=True)) + 0.5 * first, np.log(steps / steps.sum(1, keepdims=True)))
    return model


def broken(lines: list[str], states: np.ndarray) -> list[tuple[int, int]]:
    """Text lines whose last word goes on, each with the text line where it does."""
    text = [k for k, x in enumerate(lines) if states[k] == TEXT and x.strip()]
    return [(a, b) for a, b in zip(text, text[1:]) if _BROKEN.search(lines[a].rstrip()) and lines[b].lstrip()[:1].isalpha()]


def _join(a: str, b: str) -> tuple[str, int]:
    """The whole word at a break and the length of its first part."""
    head, tail = _WORD.findall(a.rstrip()[:-1]), _WORD.match(b.lstrip())
    h = head[-1] if head else ""
    return h + (tail[0] if tail else ""), len(h)


def words_of(lines: list[str], states: np.ndarray) -> Iterator[tuple[int, int, str]]:
    """``(line, following line or -1, word)`` of all text lines; a broken word once, whole."""
    cut = dict(broken(lines, states))
    to = {b: a for a, b in cut.items()}
    for k, x in enumerate(lines):
        if states[k] != TEXT or not x.strip():
            continue
        found = _WORD.findall(x)
        if k in cut and found:
            found = found[:-1]
            yield k, cut[k], _join(x, lines[cut[k]])[0].lower()
        if k in to and found:
            found = found[1:]
        for w in set(found):
            yield k, -1, w.lower()


def _label(model: LineModel, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of kinds ``header, page_no, break`` and, of kind ``word``, the words that may be misread."""
    for b in batches:
        rows = []
        for i, lines, states in _states(b, model):
            rows += [(i, k + 1, "header" if states[k] == HEADER else "page_no", None, -1) for k in np.flatnonzero(states).tolist()]
            rows += [(i, a + 1, "break", None, -1) for a, _ in broken(lines, states)]
            rows += [(i, k + 1, "word", w, n + 1 if n >= 0 else -1) for k, n, w in words_of(lines, states) if len(w) > 1 and not w.isdigit()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, (pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int32()))], names=["id", "line_no", "kind", "word", "next"])


def _lexicon(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n: Counter[str] = Counter()
    for b in batches:
        for t in b.column(0).to_pylist():
            n.update(_WORD.findall(t))
        if len(n) > 1 << 20:  # memory of a worker stays bounded; the sums are made later anyway
            yield _counted(n)
            n.clear()
    yield _counted(n)


def _counted(n: Counter[str]) -> pa.RecordBatch:
    low: Counter[str] = Counter()
    for w, k in n.items():
        low[w.lower()] += k
    return pa.RecordBatch.from_arrays([pa.array(list(low), pa.string()), pa.array(list(low.values()), pa.int64())], names=["word", "n"])


_FROM: dict[str, list[str]] = {}
for _a, _b in CONFUSIONS:
    _FROM.setdefault(_a, []).append(_b)


def repairs(word: str, most: int = 3) -> list[str]:
    """What the word may have been: up to ``most`` confusions reversed, signs inside a word always among them."""
    found: dict[str, int] = {word: 0}
    front = {word}
    for step in range(1, most + 1):
        new = set()
        for w in front:
            odd = [k for k, c in enumerate(w) if c in "0156!|89"]
            if step > 1 and not odd and step > 2:
                continue
            for k in odd[:1] or range(len(w)):
                for size in (1, 2):
                    for r in _FROM.get(w[k : k + size], ()) if len(w[k : k + size]) == size else ():
                        x = w[:k] + r + w[k + size :]
                        if x not in found:
                            found[x] = step
                            new.add(x)
        front = new
        if not any(c in "0156!|89" for w in front for c in w) and step >= (1 if any(c in "0156!|89" for c in word) else 2):
            break
    return [w for w, s in found.items() if s and not any(c in "!|" for c in w)]


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        words, n, out = b.column(0).to_pylist(), b.column(1).to_pylist(), []
        for w, k in zip(words, n):
            out += [(w, k, x) for x in repairs(w, 3 if any(c in "0156!|89" for c in w) else 1)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 3, (pa.string(), pa.int64(), pa.string()))], names=["word", "n", "fix"])


#: Words with so many occurrences are no misreadings of anything: TIMES as many of another word never occur.
def _fixes(occurring: DataFrame, lexicon: DataFrame) -> DataFrame:
    """``(word, fix)`` of the misread words among ``occurring(word)``."""
    top = lexicon.agg(F.max("n").alias("top"))
    rare = occurring.join(lexicon, "word").crossJoin(F.broadcast(top)).where((F.col("n") * TIMES <= F.col("top")) & (F.length("word") <= LONGEST)).select("word", "n")  # one row on the right
    tried = rare.mapInArrow(_candidates, "word string, n long, fix string")
    good = tried.join(lexicon.select(F.col("word").alias("fix"), F.col("n").alias("m")), "fix").where((F.col("m") >= LEAST) & (F.col("m") >= TIMES * F.col("n")))
    return good.groupBy("word").agg(F.max_by("fix", F.struct("m", "fix")).alias("fix"))


def wrapped_texts(df: DataFrame, id_col: str, body_col: str, name_cols: list[str]) -> DataFrame:
    """``(id, body, names)`` of texts with at least one line feed inside a paragraph."""
    body = F.col(body_col).cast("string")
    rows = df.select(F.col(id_col).cast("long").alias("id"), body.alias("body"), F.array(*[F.col(c).cast("string") for c in name_cols]).alias("names"))
    return spread(rows.where(F.col("body").rlike(r"[^\n]\n[^\n]")))


def scanned_lines(df: DataFrame, id_col: str = "md_id", body_col: str = "body", name_cols: tuple[str, ...] = ("title", "preacher")) -> tuple[DataFrame, DataFrame]:
    """``lines(id, line_no, kind)`` with the kinds header, page_no, break and misread, and ``fixes(word, fix)``.

    Lines are split at line feeds and counted from 1.  Null, empty and unwrapped texts have no lines here; equal
    texts have equal lines; an empty table gives an empty result; other columns are ignored.
    """
    return _scanned(df, id_col, body_col, name_cols)[:2]


def _scanned(df: DataFrame, id_col: str, body_col: str, name_cols: tuple[str, ...]) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, LineModel]:
    """Lines and repairs, and what they were made from: the texts with symbols, the marked lines and the model."""
    lined = write_table(wrapped_texts(df, id_col, body_col, list(name_cols)).mapInArrow(_symbols, _LINED), "lined", "zstd")
    model = line_model(lined)
    marked = write_table(lined.mapInArrow(lambda it: _label(model, it), "id long, line_no int, kind string, word string, next int"), "lines")
    texts = df.select(F.col(body_col).cast("string").alias("t")).where("t is not null")
    lexicon = write_table(spread(texts).mapInArrow(_lexicon, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "lexicon")
    words = marked.where("kind = 'word'")
    fixes = write_table(_fixes(words.select("word").distinct(), lexicon), "fixes")
    odd = words.join(fixes, "word")
    # a broken word is misread in the part where it differs
    where = F.when(F.col("next") > 0, _differs("word", "fix", "line_no", "next")).otherwise(F.col("line_no"))
    misread = odd.select("id", where.alias("line_no"), F.lit("misread").alias("kind")).distinct()
    return marked.where("kind <> 'word'").select("id", "line_no", "kind").unionByName(misread), fixes, lined, marked, model


def _differs(word: str, fix: str, line: str, after: str):
    """The line of the first difference: the first part is not kept, so a difference in the later half is the later line's."""
    first = F.expr(f"aggregate(sequence(1, length({word})), 0, (a, k) -> if(a = 0 and substring({word}, k, 1) <> substring({fix}, k, 1), k, a))")
    return F.when(2 * first > F.length(word) + 1, F.col(after)).otherwise(F.col(line))


def _repair(model: LineModel, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, out = [], []
        for (i, lines, states), own in zip(_states(b, model), b.column(3).to_pylist()):
            ids.append(i)
            out.append(reassemble(lines, states, dict(own or [])))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.string())], names=["id", "text"])


def reassemble(lines: list[str], states: np.ndarray, fixes: dict[str, str]) -> str:
    """Continuous paragraphs without page furniture."""

    def mend(m: re.Match) -> str:
        fix = fixes.get(m[0].lower())
        if fix is None:
            return m[0]
        return fix.upper() if m[0].isupper() and len(m[0]) > 1 else fix[:1].upper() + fix[1:] if m[0][:1].isupper() else fix

    cut = dict(broken(lines, states))
    paragraphs, now, glue = [], "", False
    for k, x in enumerate(lines):
        if states[k] != TEXT:
            continue
        x = x.strip()
        if not x:
            if now and not glue:
                paragraphs.append(now)
                now = ""
            continue
        now = now + x if glue or not now else f"{now} {x}"
        glue = k in cut
        if glue:
            sign = now[-1]
            # a hyphen before a capital, and that of a compound, belongs to the word
            after = lines[cut[k]].lstrip()
            keep = sign == "-" and (after[:1].isupper() or re.search(r"\w-\w*-$|\b(?:peut|sur|les|la|le|ci|là)-$", now, re.I) is not None)
            now = now if keep else now[:-1]
    if now:
        paragraphs.append(now)
    return "\n\n".join(_WORD.sub(mend, p) for p in paragraphs)


def repaired(df: DataFrame, id_col: str = "md_id", body_col: str = "body", name_cols: tuple[str, ...] = ("title", "preacher")) -> DataFrame:
    """``(id, text)`` of the scanned texts, repaired; other texts are not in the result."""
    lines, fixes, lined, marked, model = _scanned(df, id_col, body_col, name_cols)
    own = marked.where("kind = 'word'").join(fixes, "word").groupBy("id").agg(F.map_from_entries(F.collect_set(F.struct("word", "fix"))).alias("fixes"))
    rows = lined.join(lines.select("id").distinct(), "id", "left_semi").join(own, "id", "left").select("id", "body", "symbols", "fixes")
    return rows.mapInArrow(lambda it: _repair(model, it), "id long, text string")
