"""Matching records of two tables without a common key (problem 5): summaries and the sermons they summarise.

Method.  Sorted neighbourhood: the records of both sides are sorted together by several composite keys (day and
speaker, title words from either end, speaker and year, place and day, translated title), and a window slides over
each order; records of different sides in one window are compared field by field, and weighted similarities add up to
the evidence for a match.  Known matches teach which words of one side's titles stand for which of the other's.  Then
matches are assigned one to one so that the total evidence is the largest: a match that outweighs the best others of
both its ends together is surely part of such an assignment and is taken at once; what is left falls into small
components, each solved exactly.

Scale.  Windows slide inside range partitions; the first and last rows of each partition are joined with those of its
neighbour in a second, tiny step.  Records of one key that do not fit in a window are compared all with all, up to
``TILE`` of either side; those of a larger key only where they also share a day or two of name, place and title words,
which any pair worth a comparison does.
"""

from __future__ import annotations

import difflib
import heapq
import math
import re
import sys
from collections import Counter
from collections.abc import Iterator
from datetime import date

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import drop_table, write_table
from .components import connected_groups
from .names import _fold, initials, near, place_key, readings

WINDOW = 10
#: Records of either side in one tile of a key that is held by more than a window of them, about.
TILE = 256
#: Evidence that a pair must have to be a match.
ENOUGH = 5.0
#: Known matches that the word translations are learned from, at most.
SAMPLE = 50_000
#: Records of a component that is solved as a dense matrix; larger ones are solved over their pairs, as exactly.
COMPONENT = 400

# fixed values: names of months, and words for parts of the day
MONTHS = {m: k % 12 + 1 for k, m in enumerate("janvier fevrier mars avril mai juin juillet aout septembre octobre novembre decembre january february march april may june july august september october november december".split())}
PARTS = {"matin": "M", "morning": "M", "soir": "E", "evening": "E", "apres-midi": "A", "afternoon": "A"}
_SMALL = frozenset("the a an of and le la les l du de des d et un une s".split())
_DAY = [(re.compile(r"\b(\d{1,2})[./](\d{1,2})[./](\d{4}|\d{2})\b"), "dmy"), (re.compile(r"\b(\d{4})-(\d{2})-(\d{2})\b"), "ymd"), (re.compile(r"\b(\d{1,2})(?:er)?\s+(" + "|".join(MONTHS) + r")\s+(\d{4})\b"), "dMy"), (re.compile(r"\b(" + "|".join(MONTHS) + r")\s+(\d{4})\b"), "My"), (re.compile(r"\b(\d{4})-(\d{2})\b"), "ym"), (re.compile(r"\b(1[89]\d\d|20\d\d)\b"), "y")]
_PART = re.compile(r"\b(?:le |l'|l’)?(" + "|".join(PARTS) + r")\b(?: service)?")
_LEAD = re.compile(r"^\s*(?:resume de|d'apres|selon|summary of)\s*:?\s*")


def when(text: str | None) -> tuple[int, int, int, str]:
    """Year, month, day (0 where unknown) of the first date in a text, and the text without it."""
    if not text:
        return 0, 0, 0, ""
    for pattern, kind in _DAY:
        m = pattern.search(text)
        if not m:
            continue
        g = dict(zip(kind, m.groups()))
        y = int(g["y"])
        y += 1900 if y < 100 else 0
        mo = MONTHS[g["M"]] if "M" in g else int(g.get("m", 0))
        d = int(g.get("d", 0))
        if mo > 12:
            mo = d = 0
        try:
            if d:
                date(y, mo, d)
        except ValueError:
            d = 0
        return y, mo, d, text[: m.start()] + " " + text[m.end() :]
    return 0, 0, 0, text


def words(text: str) -> list[str]:
    return [w for w in re.findall(r"[a-z0-9]+", text.replace("œ", "oe")) if w not in _SMALL]


class Record:
    """The comparable parts of one record."""

    __slots__ = ("days", "family", "given", "guess", "id", "key", "month", "part", "place", "side", "title", "tokens", "year")

    def __init__(self, id: str, side: int, title, subtitle, day, location, preacher, lexicon: dict[str, dict[str, float]]):
        self.id, self.side = id, side
        y, m, d, _ = when(day)
        sub = _fold(subtitle or "")
        y2, m2, d2, rest = when(sub)
        # the two dates may differ by an error in either
        self.days = tuple(dict.fromkeys(date(*x).toordinal() for x in ((y, m, d), (y2, m2, d2)) if x[2]))
        if not y or (m2 and not m and y2 == y):
            y, m = y2, m2
        self.year, self.month = y, m if y else 0
        part = _PART.search(rest)
        self.part = PARTS[part[1]] if part else ""
        own = words(_fold(title or ""))
        if side == 0:
            said = _PART.sub(" ", rest)
            quoted = re.search(r"[«(\"“](.+?)[»)\"”]", said)
            said = quoted[1] if quoted else _LEAD.sub("", re.sub(r"^[\s,—–-]*(?:d'apres|selon)", "", said))
            self.title = words(said)
            self.guess = [lexicon.get(w, {}) for w in own]
        else:
            self.title, self.guess = own, []
        self.tokens = frozenset(w[:5] for w in self.title)
        self.place = place_key(location) if location and location.strip() else ""
        self.given, self.family = _speaker(preacher)


def _speaker(name: str | None) -> tuple[str, str]:
    """The likelier reading of a name: the longer word is the family name if nothing else tells."""
    options = readings(name) if name and name.strip() else []
    if not options:
        return "", ""
    if len(options) == 1 or "," in name or any("." in g for g, _ in options):
        return next(((g, f) for g, f in options if "." in g), options[0])
    upper = [w for w in name.split() if w.isupper() and len(w) > 2]
    if upper and not name.isupper():
        return next(((g, f) for g, f in options if f == _fold(" ".join(upper))), options[0])
    return options[0]


def _same_speaker(a: Record, b: Record) -> float:
    """1 the same, 0.8 as far as said, -1 another, 0 unknown."""
    if not a.family or not b.family:
        return 0
    for g1, f1 in ((a.given, a.family), (a.family, a.given)):
        if not f1 or not near(f1, b.family):
            continue
        g2 = b.given
        if not g1 or not g2:
            return 0.8
        if near(g1, g2) or ("." in g1 + g2 and (g1 == initials(g2) or g2 == initials(g1) or g1 == "m." or g2 == "m.")):
            return 1
        if "." in g1 + g2:
            return 1 if g1.rstrip(".")[:2] == g2.rstrip(".")[:2] else -0.3
        return 0.6 if g1[:1] == g2[:1] or len(g1) < 6 or len(g2) < 6 else -0.3
    if a.given and near(a.given, b.family) or b.given and near(b.given, a.family):
        return 0.8 if near(a.given, b.family) and near(a.family, b.given) else -0.5
    return -1


def _gap(a: Record, b: Record) -> int:
    """Days between the closest dates of two records that have one."""
    return min(abs(x - y) for x in a.days for y in b.days)


def promising(a: Record, b: Record) -> bool:
    """Whether the day or two other parts may agree: worth a full comparison."""
    if a.days and b.days and _gap(a, b) <= 1:
        return True
    n = (a.family != "" and (a.family == b.family or a.family == b.given or a.given == b.family)) + (a.place != "" and a.place == b.place)
    if n > 1:
        return True
    shared = len(a.tokens & b.tokens)
    return n + shared > 1 or n + sum(any(t in g for t in b.title) for g in a.guess) > 1


def evidence(a: Record, b: Record) -> float:
    """Weighted agreement of a summary ``a`` and a sermon ``b``; about a log ratio of odds."""
    total = 0.0
    if a.title and b.title:
        r = difflib.SequenceMatcher(None, " ".join(a.title), " ".join(b.title), False).ratio()
        total += 6 if r >= 0.92 else 4.5 if r >= 0.8 else 0.5 if r >= 0.66 else -1 if r >= 0.5 else -4
    if a.guess and b.title:
        known = [g for g in a.guess if g]
        if known:
            c = sum(max((g.get(t, 0.0) for t in b.title), default=0.0) for g in known) / len(known)
            total += 5 * c - 0.8
    if a.days and b.days:
        gap = _gap(a, b)
        total += 4.5 if gap == 0 else 3 if gap == 1 else -1 if gap <= 3 else -5
    elif a.year and b.year:
        if a.year != b.year:
            total -= 5
        else:
            total += (2.2 if a.month == b.month else -4) if a.month and b.month else 0.8
    total += {1: 3, 0.8: 2.3, 0.6: 1.8}.get(s := _same_speaker(a, b), 3 * s)
    if a.place and b.place:
        total += 2.5 if near(a.place, b.place) else -2.5
    if a.part and b.part:
        total += 0.7 if a.part == b.part else -1
    return total


def sort_keys(r: Record) -> list[str]:
    """Composite keys; a record without a part of a key has no such key."""
    out = []
    for day in r.days:
        out.append(f"1 {day:07d} {r.family[:4]}")
        if r.place:
            out.append(f"4 {r.place} {day:07d}")
    guess = [max(g, key=g.get) for g in r.guess if g]
    for kind, t in (("2", r.title), ("5", guess)):
        if t:
            out += [f"2 {' '.join(t)}", f"3 {' '.join(reversed(t))}"]
    if r.family and r.year:
        out.append(f"6 {r.family} {r.year} {r.month:02d} {r.days[:1]}")
        if "." not in r.given and r.given:
            out.append(f"6 {r.given} {r.year} {r.month:02d} {r.days[:1]}")
    if r.family and r.place:
        out.append(f"7 {r.place} {r.family} {r.year}")
    if r.place and r.year and not r.days:
        out.append(f"4 {r.place} {date(r.year, max(r.month, 1), 1).toordinal():07d}")
    return out


_FIELDS = ["id", "side", "title", "subtitle", "day", "location", "preacher"]
_SCHEMA = "id string, side int, title string, subtitle string, day string, location string, preacher string"


def _keyed(lexicon) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, keys = [], []
            for k, row in enumerate(zip(*(b.column(c).to_pylist() for c in range(7)))):
                for key in dict.fromkeys(sort_keys(Record(*row, lexicon.value))):
                    at.append(k)
                    keys.append(key)
            taken = b.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(keys, pa.string())], names=[*_FIELDS, "key"])

    return run


def _compare(rows: list[Record], found: dict[tuple[str, str], float], window: int, start: int = 0) -> None:
    for i in range(start, len(rows)):
        for j in range(max(0, i - window + 1), i):
            a, b = (rows[i], rows[j]) if rows[i].side == 0 else (rows[j], rows[i])
            if a.side == b.side or (a.id, b.id) in found or rows[i].key != rows[j].key:
                continue
            found[a.id, b.id] = evidence(a, b) if promising(a, b) else -9.0


def _out(found: dict[tuple[str, str], float], edge: list[tuple] = ()) -> pa.RecordBatch:
    """Pairs with evidence, and rows at the edges of partitions to be compared later."""
    kept = [(a, b, e) for (a, b), e in found.items() if e >= ENOUGH]
    cols = list(zip(*kept)) if kept else [[], [], []]
    more = list(zip(*edge)) if edge else [[]] * 9
    n, k = len(kept), len(edge)
    arrays = [pa.array([*c, *[None] * k], t) for c, t in zip(cols, (pa.string(), pa.string(), pa.float64()))]
    kinds = (pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32())
    arrays += [pa.array([*[None] * n, *c], t) for c, t in zip(more, kinds)]
    return pa.RecordBatch.from_arrays(arrays, names=["a", "b", "e", *_FIELDS, "key", "part"])


_OUT = f"a string, b string, e double, {_SCHEMA}, key string, part int"


def _slide(lexicon, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        tail: list[Record] = []
        last: list[tuple] = []
        seen = 0
        for b in batches:
            raw = list(zip(*(b.column(c).to_pylist() for c in range(8))))
            rows = [Record(*r[:7], lexicon.value) for r in raw]
            for r, x in zip(rows, raw):
                r.key = x[7][0]
            found: dict[tuple[str, str], float] = {}
            _compare(tail + rows, found, window, len(tail))
            head = [(*x, part - 1) for x in raw[: max(0, window - 1 - seen)]]
            yield _out(found, head)
            seen += len(rows)
            tail, last = (tail + rows)[-(window - 1) :], (last + raw)[-(window - 1) :]
        yield _out({}, [(*x, part) for x in last])

    return run


def _seam(lexicon, window: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for x in pdf.sort_values("key", kind="stable").itertuples(index=False):
            vals = [None if isinstance(v, float) and math.isnan(v) else v for v in (x.id, x.side, x.title, x.subtitle, x.day, x.location, x.preacher)]
            r = Record(*vals, lexicon.value)
            r.key = x.key[0]
            rows.append(r)
        found: dict[tuple[str, str], float] = {}
        _compare(rows, found, window)
        kept = [(a, b, e) for (a, b), e in found.items() if e >= ENOUGH]
        return pd.DataFrame(kept, columns=["a", "b", "e"])

    return run


def points(r: Record) -> list[str]:
    """What ``promising`` looks at: every promising pair has a day or two of the other points in common."""
    out = {f"n {x}" for x in (r.family, r.given) if x} | {f"t {x}" for x in r.tokens}
    if r.place:
        out.add(f"p {r.place}")
    out |= {f"w {w}" for w in (r.title if r.side else {w for g in r.guess for w in g})}
    at = sorted(out)
    two = [f"{x}|{y}" for k, x in enumerate(at) for y in at[k + 1 :]]
    return two + sorted({f"d {d + k}" for d in r.days for k in ((0,) if r.side else (-1, 0, 1))})


def _pointed(lexicon) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, keys = [], []
            for k, row in enumerate(zip(*(b.column(c).to_pylist() for c in range(7)))):
                own = points(Record(*row, lexicon.value))
                at += [k] * len(own)
                keys += own
            yield pa.RecordBatch.from_arrays([*b.take(pa.array(at, pa.int64())).columns, pa.array(keys, pa.string())], names=[*_FIELDS, "key"])

    return run


def _blocks(keyed: DataFrame, lexicon, window: int, tile: int = TILE) -> DataFrame:
    """Evidence of the pairs of equal keys that are held by more records than a window takes.

    A key held by at most ``tile`` records of either side is one task's work.  Records of larger ones are joined once
    more, by what two of them must have in common to be worth a comparison; only where many have that in common, too,
    all pairs are compared, in tiles.
    """

    def sizes_of(rows: DataFrame) -> DataFrame:
        return rows.groupBy("key").agg(F.count_if(F.col("side") == 0).alias("n0"), F.count_if(F.col("side") == 1).alias("n1")).where("n0 > 0 and n1 > 0")

    def tiled(rows: DataFrame) -> DataFrame:
        tiles = [F.ceil(F.col(n) / tile).cast("int") for n in ("n0", "n1")]
        own = F.pmod(F.xxhash64("id"), F.when(F.col("side") == 0, tiles[0]).otherwise(tiles[1])).cast("int")
        rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("side") == 0, tiles[1]).otherwise(tiles[0]) - 1)))
        x, y = (F.when(F.col("side") == k, F.col("own")).otherwise(F.col("other")) for k in (0, 1))
        return rows.select(*_FIELDS, "key", x.alias("x"), y.alias("y")).groupBy("key", "x", "y").applyInPandas(_seam(lexicon, sys.maxsize), "a string, b string, e double")

    sizes = write_table(sizes_of(keyed).where(f"n0 + n1 > {window}"), "sizes")
    out = tiled(keyed.join(sizes.where(f"n0 <= {tile} and n1 <= {tile}"), "key"))
    large = sizes.where(f"n0 > {tile} or n1 > {tile}")
    if large.isEmpty():
        return out
    # one kind of key for all: a pair of any kind is found by its points
    again = keyed.join(large.select("key"), "key", "left_semi").select(*_FIELDS).distinct().mapInArrow(_pointed(lexicon), f"{_SCHEMA}, key string")
    again = write_table(again, "points")
    return out.unionByName(tiled(again.join(sizes_of(again), "key")))


def _learn(known: DataFrame) -> dict[str, dict[str, float]]:
    """For each word of the summaries' titles the words that stand for it, with their share, from known matches."""
    pairs: Counter[tuple[str, str]] = Counter()
    one: Counter[str] = Counter()
    other: Counter[str] = Counter()
    n = 0
    for r in known.toLocalIterator():
        x, y = set(words(_fold(r.ta or ""))), set(words(_fold(r.tb or "")))
        if x and y:
            n += 1
            one.update(x)
            other.update(y)
            pairs.update((p, q) for p in x for q in y)
    out: dict[str, dict[str, float]] = {}
    for (p, q), c in pairs.items():
        if c > 1 and c * n > 4 * one[p] * other[q] and c >= 0.25 * one[p]:
            out.setdefault(p, {})[q] = min(1.0, 1.6 * c / one[p])
    return out


def match(left: DataFrame, right: DataFrame, known: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(path_a, path_b, confidence)``: at most one match for each record of either side.

    ``left`` and ``right`` have ``id, title, subtitle, day, location, preacher``, one row for each id; ``known`` has
    ``a, b``, matches that are given: they are kept, with confidence 1, as far as they are one to one.  Null fields
    say nothing; records without any usable field match nothing; empty tables give an empty result.
    """
    spark = left.sparkSession
    fields = ["id", "title", "subtitle", "day", "location", "preacher"]
    rows = write_table(left.select(*fields).withColumn("side", F.lit(0)).unionByName(right.select(*fields).withColumn("side", F.lit(1))).where("id is not null").select(*_FIELDS), "records")
    titles = rows.select("id", "side", "title")
    taught = known.join(titles.where("side = 0").select(F.col("id").alias("a"), F.col("title").alias("ta")), "a").join(titles.where("side = 1").select(F.col("id").alias("b"), F.col("title").alias("tb")), "b")
    taught = write_table(taught.select("a", "b", "ta", "tb").distinct(), "known")
    lexicon = spark.sparkContext.broadcast(_learn(taught.orderBy(F.xxhash64("a")).limit(SAMPLE)))
    keyed = write_table(rows.mapInArrow(_keyed(lexicon), f"{_SCHEMA}, key string"), "keyed")
    slid = write_table(keyed.repartitionByRange("key").sortWithinPartitions("key", "id").mapInArrow(_slide(lexicon, window), _OUT), "slid")
    seams = slid.where("part >= 0").groupBy("part").applyInPandas(_seam(lexicon, window), "a string, b string, e double")
    pairs = slid.where("a is not null").select("a", "b", "e").unionByName(seams).unionByName(_blocks(keyed, lexicon, window)).groupBy("a", "b").agg(F.max("e").alias("e"))
    # given matches outweigh all others
    given = one_to_one(taught.select("a", "b").distinct().withColumn("e", F.lit(1.0)))
    free = pairs.join(given.select("a"), "a", "left_anti").join(given.select("b"), "b", "left_anti")
    best = one_to_one(free)
    confidence = 1 / (1 + F.exp(-(F.col("e") - 3.5)))
    out = best.select("a", "b", confidence.alias("confidence")).unionByName(given.select("a", "b", F.lit(1.0).alias("confidence")))
    return out.select(F.col("a").alias("path_a"), F.col("b").alias("path_b"), "confidence")


def one_to_one(pairs: DataFrame) -> DataFrame:
    """The assignment ``(a, b, e)`` of the largest total evidence, all evidences being positive."""
    rest = write_table(pairs.select("a", "b", "e"), "edges")
    taken: list[DataFrame] = []
    while True:
        ranked = rest
        for x, y in (("a", "b"), ("b", "a")):
            top = rest.groupBy(x).agg(F.max(F.struct("e", F.col(y).alias("o"))).alias("t"), F.count("*").alias("n"))
            second = rest.join(top.select(x, F.col("t.o").alias(y)), [x, y], "left_anti").groupBy(x).agg(F.max("e").alias("s"))
            top = top.join(second, x, "left").select(x, F.col("t.o").alias(f"best_{x}"), F.coalesce("s", F.lit(0.0)).alias(f"next_{x}"))
            ranked = ranked.join(top, x)
        sure = write_table(ranked.where("best_a = b and best_b = a and e >= next_a + next_b").select("a", "b", "e"), "sure")
        if sure.isEmpty():
            break
        taken.append(sure)
        left = write_table(rest.join(sure.select("a"), "a", "left_anti").join(sure.select("b"), "b", "left_anti"), "edges")
        drop_table(rest)
        rest = left
        if rest.isEmpty():
            break
    out = rest.limit(0)
    for t in taken:
        out = out.unionByName(t)
    if rest.isEmpty():
        return out
    sides = rest.select(F.concat(F.lit("0"), "a").alias("a"), F.concat(F.lit("1"), "b").alias("b"))
    groups = connected_groups(sides, "a", "b").where("record like '0%'").select(F.expr("substring(record, 2)").alias("a"), "group")
    edges = rest.join(groups, "a")
    return out.unionByName(edges.groupBy("group").applyInPandas(_assign, "a string, b string, e double"))


def _assign(pdf: pd.DataFrame) -> pd.DataFrame:
    """Maximum-weight matching of one component: the Hungarian method on its evidence, absent pairs weighing nothing."""
    a, b = sorted(pdf.a.unique()), sorted(pdf.b.unique())
    ia, ib = {x: k for k, x in enumerate(a)}, {x: k for k, x in enumerate(b)}
    if len(pdf) > COMPONENT * 4:
        near_: list[dict[int, float]] = [{} for _ in a]
        for x, y, e in zip(pdf.a, pdf.b, pdf.e):
            near_[ia[x]][ib[y]] = max(near_[ia[x]].get(ib[y], e), e)
        rows = [(a[i], b[j], near_[i][j]) for i, j in enumerate(_sparse(near_, len(b))) if j >= 0]
        return pd.DataFrame(rows, columns=["a", "b", "e"])
    w = np.zeros((max(len(a), len(b)),) * 2)
    for x, y, e in zip(pdf.a, pdf.b, pdf.e):
        w[ia[x], ib[y]] = max(w[ia[x], ib[y]], e)
    to = _hungarian(-w)
    rows = [(a[i], b[j], w[i, j]) for i, j in enumerate(to) if i < len(a) and j < len(b) and w[i, j] > 0]
    return pd.DataFrame(rows, columns=["a", "b", "e"])


def _sparse(weights: list[dict[int, float]], n: int) -> list[int]:
    """Column of each row, or -1, in a matching of the largest weight; as ``_hungarian``, over the pairs there are.

    Each row has a column of its own, of no weight, that leaves it free.
    """
    cost = [[*((j, -e) for j, e in w.items()), (n + i, 0.0)] for i, w in enumerate(weights)]
    u, v = [0.0] * len(cost), [0.0] * (n + len(cost))
    row_of, col_of = [-1] * len(v), [-1] * len(cost)
    for first in range(len(cost)):
        u[first] = min(c - v[j] for j, c in cost[first])
        least: dict[int, float] = {}
        way: dict[int, int] = {}
        done: set[int] = set()
        heap: list[tuple[float, int]] = []
        i, far = first, 0.0
        while True:
            for j, c in cost[i]:
                d = far + c - u[i] - v[j]
                if j not in done and d < least.get(j, math.inf):
                    least[j], way[j] = d, i
                    heapq.heappush(heap, (d, j))
            far, j = heapq.heappop(heap)
            while j in done:
                far, j = heapq.heappop(heap)
            done.add(j)
            if row_of[j] < 0:
                break
            i = row_of[j]
        u[first] += far
        for k in done:
            v[k] -= far - least[k]
            if row_of[k] >= 0:
                u[row_of[k]] += far - least[k]
        while True:
            i = way[j]
            row_of[j] = i
            col_of[i], j = j, col_of[i]
            if i == first:
                break
    return [j if j < n else -1 for j in col_of]


def _hungarian(cost: np.ndarray) -> list[int]:
    """Column of each row in a least-cost assignment of a square matrix; shortest augmenting paths with potentials."""
    n = len(cost)
    u, v, match_of = np.zeros(n), np.zeros(n + 1), np.full(n + 1, -1)
    for i in range(n):
        match_of[n] = i
        least, used, way = np.full(n, np.inf), np.zeros(n + 1, bool), np.full(n, n)
        j = n
        while match_of[j] >= 0:
            used[j] = True
            r = match_of[j]
            gap = cost[r] - u[r] - v[:n]
            better = ~used[:n] & (gap < least)
            least[better], way[better] = gap[better], j
            open_ = np.where(used[:n], np.inf, least)
            k = int(open_.argmin())
            step = open_[k]
            u[match_of[used]] += step
            v[used] -= step
            least[~used[:n]] -= step
            j = k
        while j != n:
            before = way[j]
            match_of[j] = match_of[before]
            j = before
    to = [0] * n
    for j in range(n):
        to[match_of[j]] = j
    return to


def latest(df: DataFrame, id_col: str, fields: list[str], at: str) -> DataFrame:
    """One row for each id: every field's latest value that is not null."""
    return df.groupBy(F.col(id_col).alias("id")).agg(*[F.max_by(f, F.when(F.col(f).isNotNull(), F.col(at))).alias(f) for f in fields])
