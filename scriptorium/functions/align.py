"""Alignment of a text with its source: anchors, word differences, common letters, page headers.

Pairs of texts are aligned one by one inside Arrow batches; the pairs come from an equi-join, never a cross join.
"""

from __future__ import annotations

import difflib
import functools
import itertools
import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .refs import citations

_WORD = re.compile(r"\w+(?:['’]\w+)*")


def fold(s: str) -> str:
    plain = "".join(c for c in unicodedata.normalize("NFD", s.lower()) if not unicodedata.combining(c))
    return plain.replace("œ", "oe").replace("æ", "ae").replace("’", "'")


_letter = functools.lru_cache(1 << 16)(fold)


class Places:
    """Places of short word sequences in a source, looked up by their folded words."""

    def __init__(self, source: list[str]):
        self.words = [fold(w) for w in source]
        self.at: dict[int, dict[tuple[str, ...], list[int]]] = {}

    def _of(self, gram: list[str]) -> list[int]:
        n = len(gram)
        if n not in self.at:
            self.at[n] = {}
            for k in range(len(self.words) - n + 1):
                self.at[n].setdefault(tuple(self.words[k : k + n]), []).append(k)
        return self.at[n].get(tuple(gram), [])

    def between(self, before: list[str], after: list[str]) -> tuple[int, int] | None:
        b, a = [fold(w) for w in before[-2:]], [fold(w) for w in after[:3]]
        ends, found = self._of(a), None
        for k in self._of(b) if ends else []:
            s = k + len(b)
            for e in ends[bisect_left(ends, s) : bisect_right(ends, s + 12)]:
                if found:
                    return None
                found = (s, e)
        return found


def anchor(before: list[str], after: list[str], source: list[str]) -> tuple[int, int] | None:
    """The words of ``source`` between the two words before and the three after, if they stand there exactly once."""
    return Places(source).between(before, after)


def anchored(text: list[str], source: list[str]) -> int:
    """How many words of a text, all but its first two and last three, are located in its source by their neighbours."""
    places = Places(source)
    return sum(places.between(text[k - 2 : k], text[k + 1 : k + 4]) is not None for k in range(2, len(text) - 3))


def differing(text: list[str], source: list[str]) -> list[int]:
    """Positions of a text off a longest common subsequence of its words and the source's."""
    same = {i for i, _ in _common(text, source)}
    return [k for k in range(len(text)) if k not in same]


def restore_spots(text: list[str], spots: list[int], source: list[str]) -> tuple[list[str], list[int]]:
    """Words at ``spots`` replaced by the source's where their anchors say so, and the spots that stay unresolved.

    Passes go on until none changes anything, as a restored word may anchor its neighbour; a place of the source that
    two spots claim confirms neither.
    """
    text, left, places = list(text), list(spots), Places(source)
    hits: dict[int, tuple[int, int] | None] = {}
    while True:
        claims: dict[tuple[int, int], list[int]] = {}
        for s in left:
            if s not in hits:
                hits[s] = places.between(text[max(0, s - 2) : s], text[s + 1 : s + 4])
            hit = hits[s]
            if hit and hit[1] - hit[0] == 1:
                claims.setdefault(hit, []).append(s)
        sure = {s[0]: hit for hit, s in claims.items() if len(s) == 1}
        changed = {s: source[h[0]] for s, h in sure.items()}
        if not changed:
            return text, left
        for s, w in changed.items():
            text[s] = w
            for k in range(s - 3, s + 3):
                hits.pop(k, None)
        left = [s for s in left if s not in changed]


def _edit(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def restore_words(text: str, source: str, most: int = 3) -> str:
    """Words that differ from the source by accents, ligatures or at most ``most`` edits, written as in the source.

    A change is kept only if the citations around it stay the same.
    """
    spans = [m.span() for m in _WORD.finditer(text)]
    mine, theirs = [text[a:b] for a, b in spans], _WORD.findall(source)
    m = difflib.SequenceMatcher(None, [fold(w) for w in mine], [fold(w) for w in theirs], False)
    edits: list[tuple[int, int, str]] = []
    for kind, a, b, c, d in m.get_opcodes():
        if kind == "equal" or kind == "replace" and b - a == d - c:
            for k in range(b - a):
                x, y = mine[a + k], theirs[c + k]
                if x != y and (kind == "equal" and x.lower() != y.lower() or kind == "replace" and not x.isdigit() and _edit(fold(x), fold(y)) <= most):
                    edits.append((*spans[a + k], y))
    for a, b, y in reversed(edits):
        new = text[:a] + y + text[b:]
        lo = max(0, a - 200)
        if [r for _, _, r in citations(text[lo : b + 200])] == [r for _, _, r in citations(new[lo : a + len(y) + 200])]:
            text = new
    return text


def _rows(x: list, masks: dict, width: int, row: int) -> Iterator[int]:
    """Rows of the table of common lengths before each of ``x`` and after the last; a zero bit is a step by one."""
    full = (1 << width) - 1
    for c in x:
        yield row
        u = row & masks.get(c, 0)
        row = ((row + u) | (row - u)) & full
    yield row


def _common(x: list, y: list) -> list[tuple[int, int]]:
    """Index pairs of a longest common subsequence.

    A row of the table is one integer of ``len(y)`` bits, from the end of both lists; every row of a stretch is kept
    at a time, of the others only each stretch's first, so the store grows by the root of ``len(x)``.
    """
    same = next((k for k, (a, b) in enumerate(zip(x, y)) if a != b), min(len(x), len(y)))
    head, x, y = [(k, k) for k in range(same)], x[same:], y[same:]
    n, m = len(x), len(y)
    if not n or not m:
        return head
    masks: dict = {}
    for j, c in enumerate(y):
        masks[c] = masks.get(c, 0) | 1 << (m - 1 - j)
    step = max(1, int(n**0.5))
    back = x[::-1]
    starts = [r for k, r in enumerate(_rows(back, masks, m, (1 << m) - 1)) if k % step == 0]
    block, rows = -1, []

    def length(i: int, j: int) -> int:
        nonlocal block, rows
        k = n - i
        if not block * step <= k <= block * step + step or block < 0:
            block = (k - 1) // step if k else 0
            rows = list(_rows(back[block * step : block * step + step], masks, m, starts[block]))
        return m - j - (rows[k - block * step] & ((1 << (m - j)) - 1)).bit_count()

    out, i, j = head, 0, 0
    while i < n and j < m:
        if x[i] == y[j]:
            out.append((i + same, j + same))
            i, j = i + 1, j + 1
        elif length(i + 1, j) >= length(i, j + 1):
            i += 1
        else:
            j += 1
    return out


def common_letters(a: str, b: str) -> list[tuple[int, int]]:
    """Index pairs of a longest common subsequence of the letters of two texts."""
    x, y = [k for k, c in enumerate(a) if c.isalpha()], [k for k, c in enumerate(b) if c.isalpha()]
    return [(x[i], y[j]) for i, j in _common([_letter(a[k]) for k in x], [_letter(b[k]) for k in y])]


@functools.lru_cache(1 << 16)
def _sounds(c: str) -> bool:
    return c.isalnum() or unicodedata.category(c)[0] in "MN"


def with_signs(letters: str, signed: str) -> str:
    """``letters`` with the signs that stand between the same letters and digits in ``signed``.

    A gap of ``letters`` that has signs of its own stays; so does its white space where only the source has a line
    break, and signs that stand at a line break of ``letters`` alone go before it.
    """
    x, y = ([k for k, c in enumerate(t) if _sounds(c)] for t in (letters, signed))
    ends = [(-1, -1), *_common([_letter(letters[k]) for k in x], [_letter(signed[k]) for k in y]), (len(x), len(y))]
    x, y = [*x, len(letters), -1], [*y, len(signed), -1]
    out, at = [], 0
    for (i, j), (k, m) in itertools.pairwise(ends):
        if y[m] - y[j] == 1 or k - i != 1 or m - j != 1:
            continue
        lo, hi = x[i] + 1, x[k]
        mine, theirs = letters[lo:hi], signed[y[j] + 1 : y[m]]
        if mine.strip() or not theirs.strip():
            continue
        if "\n" in theirs and "\n" not in mine:
            theirs = re.sub(r"\s*\n\s*", " " if mine else "", theirs)
        elif "\n" in mine and "\n" not in theirs:
            theirs = theirs.rstrip() + mine
        out += [letters[at:lo], theirs]
        at = hi
    return "".join([*out, letters[at:]])


def strip_headers(text: str, source: str, least: int = 3) -> str:
    """Lines that come again and again in the source (page headers) removed where they interrupt the text."""
    seen: dict[str, int] = {}
    for line in source.split("\n"):
        k = re.sub(r"[\W\d_]+", " ", fold(line)).strip()
        if 3 < len(k) < 80:
            seen[k] = seen.get(k, 0) + 1
    heads = {k for k, n in seen.items() if n >= least}
    out: list[str] = []
    for line in text.split("\n"):
        k = re.sub(r"[\W\d_]+", " ", fold(line)).strip()
        if k in heads:
            continue
        if out and out[-1] and line and not re.search(r"[.!?:»]\s*$", out[-1]) and line[:1].islower():
            out[-1] = out[-1].rstrip() + " " + line
        else:
            out.append(line)
    return re.sub(r"\n{3,}", "\n\n", "\n".join(out)).strip()


_KINDS = {"words": restore_words, "signs": with_signs, "headers": strip_headers}


def aligned(pairs: DataFrame, kind: str) -> DataFrame:
    """``(id, text)``: each text of ``pairs(id, text, source)`` after one of the alignments; null if either is null."""
    run = _KINDS[kind]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [None if t is None or s is None else run(t, s) for t, s in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=["id", "text"])

    return pairs.select("id", "text", "source").mapInArrow(each, f"id {pairs.schema['id'].dataType.simpleString()}, text string")
