"""Record linkage: similarity joins, tiered matches, rule cascades that never guess, groups and keepers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity as sim
from ..shared import drop_table, hot_join, write_counted, write_table


def exploded(df: DataFrame, id_col: str, items: Column) -> DataFrame:
    """``(id, item)`` of an array of distinct items, hashed to 64 bits."""
    return df.select(F.col(id_col).alias("id"), F.explode(items).alias("item")).select("id", F.xxhash64("item").alias("item"))


def shared_pairs(items: DataFrame, most: int = 20, least: int = 2) -> DataFrame:
    """``(a, b, shared)`` with ``a < b`` over items held by 2 to ``most`` records: an inverted index joined with itself.

    The cap on holders is part of what is asked (an item of very many records says nothing), and bounds each group.
    """
    df = items.groupBy("item").agg(F.count("*").alias("holders")).where(F.col("holders").between(2, most)).select("item")
    kept = items.join(df, "item")
    pairs = kept.select("item", F.col("id").alias("a")).join(kept.select("item", F.col("id").alias("b")), "item").where("a < b")
    return pairs.groupBy("a", "b").agg(F.count("*").alias("shared")).where(F.col("shared") >= least)


def with_containment(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """Shares of both sides and the band of each pair; ``sizes`` is ``(id, n)``."""
    a = sizes.select(F.col("id").alias("a"), F.col("n").alias("n_a"))
    b = sizes.select(F.col("id").alias("b"), F.col("n").alias("n_b"))
    rows = pairs.join(a, "a").join(b, "b").withColumn("share_a", sim.containment(F.col("shared"), F.col("n_a"))).withColumn("share_b", sim.containment(F.col("shared"), F.col("n_b")))
    return rows.withColumn("band", sim.band(F.col("share_a"), F.col("share_b")))


#: Items that most records hold, as bits of every record.
COMMON = 256
#: Records of either side that one task compares at most, and least parts of either side.
LEFT_ROWS, RIGHT_ROWS, LEFT_PARTS, RIGHT_PARTS = 1 << 17, 1 << 18, 4, 6
_SET = "side int, id long, n int, common binary, rest array<long>"


def _sets(common: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets of items as bits of the ``common`` ones, which are in order, and a list of the rest."""
    for b in batches:
        b = b.filter(pc.greater(pc.list_value_length(b.column(2)), 0))  # noqa: PLW2901
        items = b.column(2)
        n = pc.list_value_length(items).to_numpy(zero_copy_only=False).astype(np.int64)
        flat, owner = items.flatten().to_numpy(), np.repeat(np.arange(len(n)), n)
        at = np.minimum(np.searchsorted(common, flat), len(common) - 1)
        is_common = common[at] == flat
        bits = np.zeros((len(n), COMMON), bool)
        bits[owner[is_common], at[is_common]] = True
        cut = np.r_[0, np.cumsum(np.bincount(owner[~is_common], minlength=len(n)))].astype(np.int32)
        rest = pa.ListArray.from_arrays(pa.array(cut), pa.array(flat[~is_common]))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n.astype(np.int32)), pa.array([x.tobytes() for x in np.packbits(bits, axis=1)], pa.binary()), rest], names=["side", "id", "n", "common", "rest"])


class _Side:
    """Sets of one side in the order of their sizes; ``code`` numbers what is not common."""

    def __init__(self, t: pa.Table):
        t = t.sort_by("n")
        self.id, self.n = t["id"].to_numpy(), t["n"].to_numpy().astype(np.int64)
        self.common = np.frombuffer(b"".join(t["common"].to_pylist()), np.uint8).reshape(len(t), COMMON // 8)
        self.rest = pc.list_value_length(t["rest"]).to_numpy().astype(np.int64)
        self.first = np.cumsum(self.rest) - self.rest
        self.items = pc.list_flatten(t["rest"]).to_numpy()

    def keys(self, rows: np.ndarray) -> np.ndarray:
        """For each of ``rows`` the codes of its rest, below the place in ``rows``."""
        n = self.rest[rows]
        k = np.repeat(np.arange(len(rows)), n)
        return k << 32 | self.code[np.repeat(self.first[rows], n) + np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n)]


def _best_in(left: _Side, right: _Side, least: float) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``left`` the largest similarity, and the smallest id of ``right`` that has it; 0 where none reaches ``least``.

    A pair must share ``part`` of the sum of both sizes; it shares at most the common items of both, which a product of
    matrices counts, and the rest of the smaller rest.  Only where that is enough the rests are compared.
    """
    part = least / (1 + least)
    _, code = np.unique(np.r_[left.items, right.items], return_inverse=True)
    left.code, right.code = code[: len(left.items)], code[len(left.items) :]
    best, to = np.zeros(len(left.n)), np.zeros(len(left.n), np.int64)
    one = lambda n: np.ones((n, 1), np.float32)
    for r0 in range(0, len(right.n), 4096):
        r = slice(r0, r0 + 4096)
        rn, rr = right.n[r], right.rest[r]
        b = np.hstack([np.unpackbits(right.common[r], axis=1).astype(np.float32), one(len(rn)), (-part * rn)[:, None].astype(np.float32)]).T
        for l0 in range(0, len(left.n), 1024):
            own = slice(l0, l0 + 1024)
            ln, lr = left.n[own], left.rest[own]
            if ln[-1] < least * rn[0] or rn[-1] < least * ln[0]:
                continue
            a = np.hstack([np.unpackbits(left.common[own], axis=1).astype(np.float32), (lr - part * ln)[:, None].astype(np.float32), one(len(ln))])
            score = (a @ b).ravel()  # common items and the rest of the left set, less what is needed
            hit = np.flatnonzero(score >= -0.01)
            i, j = hit // len(rn), hit % len(rn)
            both = np.rint(score[hit] - lr[i] + part * (ln[i] + rn[j])).astype(np.int64)
            enough = both + np.minimum(lr[i], rr[j]) >= part * (ln[i] + rn[j]) - 0.01
            i, j, both = i[enough], j[enough], both[enough]
            if not len(i):
                continue
            keys = np.r_[left.keys(l0 + i), right.keys(r0 + j)]
            keys.sort()
            both += np.bincount(keys[1:][keys[1:] == keys[:-1]] >> 32, minlength=len(i))
            like = both / (ln[i] + rn[j] - both)
            enough = like >= least
            i, like, other = l0 + i[enough], like[enough], right.id[r0 + j[enough]]
            order = np.lexsort((other, -like, i))
            order = order[np.r_[True, i[order][1:] != i[order][:-1]]] if len(order) else order
            i, like, other = i[order], like[order], other[order]
            better = (like > best[i]) | ((like == best[i]) & (other < to[i]))
            best[i[better]], to[i[better]] = like[better], other[better]
    return best, to


def jaccard_best(left: DataFrame, right: DataFrame, least: float = 0.5) -> DataFrame:
    """``(id, best, similarity)``: for each left record the right one most like it, if at least ``least``, which is above 0.

    Both are ``(id, items)`` of distinct items, which are integers; ties go to the smaller id.  Sets of common words all
    meet each other, so an index of items lists as many pairs as there are; here parts of both sides meet in one
    task each and only the best of each record leaves it.  Time grows with the product of both sides, disk does not.
    """
    rows = left.select(F.lit(0).alias("side"), "id", "items").unionByName(right.select(F.lit(1).alias("side"), "id", "items"))
    table, n = write_counted(rows.where("id is not null"), "sets", left=F.count_if(F.col("side") == 0), right=F.count_if(F.col("side") == 1))
    top = table.select(F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "item").limit(COMMON).collect()
    common = np.array(sorted(r.item for r in top) or [0], np.int64)
    parts = [max(LEFT_PARTS, -(-n["left"] // LEFT_ROWS)), max(RIGHT_PARTS, -(-n["right"] // RIGHT_ROWS))]
    own = F.when(F.col("side") == 0, F.pmod(F.xxhash64("id"), F.lit(parts[0]))).otherwise(F.pmod(F.xxhash64("id"), F.lit(parts[1])))
    all_of = lambda k: F.sequence(F.lit(0), F.lit(k - 1))
    cells = F.when(F.col("side") == 0, F.transform(all_of(parts[1]), lambda k: own * parts[1] + k)).otherwise(F.transform(all_of(parts[0]), lambda k: k * parts[1] + own))
    met = table.mapInArrow(lambda it: _sets(common, it), _SET).withColumn("cell", F.explode(cells)).withColumn("cell", F.col("cell").cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        t = pa.Table.from_batches(got) if got else None
        for cell in pc.unique(t["cell"]).to_pylist() if got else []:
            here = t.filter(pc.equal(t["cell"], cell))
            a, b = (_Side(here.filter(pc.equal(here["side"], k))) for k in range(2))
            best, to = _best_in(a, b, least)
            some = best > 0
            yield pa.RecordBatch.from_arrays([pa.array(a.id[some]), pa.array(to[some]), pa.array(best[some])], names=["id", "best", "similarity"])

    found = met.repartitionById(parts[0] * parts[1], "cell").mapInArrow(run, "id long, best long, similarity double")
    return found.groupBy("id").agg(F.max_by("best", F.struct("similarity", -F.col("best"))).alias("best"), F.max("similarity").alias("similarity"))


def tiers(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """``(id, match, tier)``: the match by the first key that has one; without any, tier ``unique``.

    Each key must lead to one record at most: of several, the smallest id counts.
    """
    out = left
    for k in keys:
        one = right.where(F.col(k).isNotNull()).groupBy(k).agg(F.min("id").alias(f"by_{k}"))
        out = out.join(one, k, "left")
    match = F.coalesce(*[F.col(f"by_{k}") for k in keys])
    tier = F.coalesce(*[F.when(F.col(f"by_{k}").isNotNull(), F.lit(k)) for k in keys], F.lit("unique"))
    return out.select("id", match.alias("match"), tier.alias("tier"))


def cascade(candidates: DataFrame, rules: dict[str, Column], left: str = "a", right: str = "b") -> tuple[DataFrame, DataFrame]:
    """Matches ``(a, b, rule)`` by the first rule that leaves exactly one candidate, and what stays unresolved.

    A rule that leaves several candidates decides nothing; the next one is tried on all of them.
    """
    w = Window.partitionBy(left)
    rows = candidates
    for k, (name, hit) in enumerate(rules.items()):
        rows = rows.withColumn(f"_h{k}", F.coalesce(hit, F.lit(False)))
        rows = rows.withColumn(f"_n{k}", F.sum(F.col(f"_h{k}").cast("int")).over(w))
    rule = F.coalesce(*[F.when(F.col(f"_n{k}") == 1, F.lit(k)) for k in range(len(rules))])
    rows = rows.withColumn("_rule", rule)
    chosen = F.lit(False)
    for k in range(len(rules)):
        chosen = chosen | ((F.col("_rule") == k) & F.col(f"_h{k}"))
    names = F.array(*[F.lit(n) for n in rules])
    matched = rows.where(chosen).select(left, right, F.get(names, F.col("_rule")).alias("rule"))
    return matched, rows.where("_rule is null").select(left).distinct()


def one_to_one(matches: DataFrame, target: str = "b", decided: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Matches whose target is claimed once; of several claims only a single decided one stays. And the refused ones."""
    w = Window.partitionBy(target)
    rows = matches.withColumn("_n", F.count("*").over(w))
    ok = F.col("_n") == 1
    if decided:
        rows = rows.withColumn("_d", F.sum(F.col(decided).cast("int")).over(w))
        ok = ok | ((F.col("_d") == 1) & F.col(decided))
    drop = ["_n", "_d"] if decided else ["_n"]
    return rows.where(ok).drop(*drop), rows.where(~ok).drop(*drop)


#: A vertex with more than this share of the edges is hot: at most ``2 / HOT`` are.
HOT = 1 / 500
#: Rows of a key that are never too many for a task.
LEAST_HOT = 10_000
#: Edges that one task solves; more of them are solved by star contraction, with equal labels.
CORE = 1 << 20


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Smallest vertex of each component, for edges that fit in memory."""
    parts = [pa.concat_arrays([b.column(k) for k in range(2)]) for b in batches]
    if not parts:
        return
    both = pc.dictionary_encode(pa.concat_arrays([p[: len(p) // 2] for p in parts] + [p[len(p) // 2 :] for p in parts]))
    v, at = both.dictionary, both.indices.to_numpy()
    order = pc.sort_indices(v).to_numpy()
    rank = np.empty(len(v), np.int64)
    rank[order] = np.arange(len(v))
    a, b = np.split(rank[at], 2)
    label = np.arange(len(v))
    while True:
        x, y = label[a], label[b]
        if (x == y).all():
            break
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]
    moved = np.flatnonzero(label != np.arange(len(v)))
    yield pa.RecordBatch.from_arrays([v.take(pa.array(order[moved])), v.take(pa.array(order[label[moved]]))], names=["v", "label"])


def contracted(edges: DataFrame, n: int, core: int = CORE) -> DataFrame:
    """Components ``(v, label)`` of ``n`` edges ``a < b`` but for the labels themselves; ``core`` edges fit in one task."""
    if n > core:
        return stars(edges, n)
    kind = edges.schema["a"].dataType.simpleString()
    return edges.select("a", "b").repartition(1).mapInArrow(_solve, f"v {kind}, label {kind}")


def stars(edges: DataFrame, n: int) -> DataFrame:
    """Components ``(v, label)`` of ``n`` edges ``a < b``, labelled by the smallest vertex: large-star, small-star steps.

    Edges of a hot vertex are never brought to one task.  The vertices that are labels are not in the result.
    """
    now, state = edges, None
    while True:
        # large star: neighbours greater than v go to the smallest of v and its neighbours
        both = now.select(F.explode(F.array(F.struct(F.col("a").alias("v"), F.col("b").alias("w")), F.struct(F.col("b").alias("v"), F.col("a").alias("w")))).alias("e")).select("e.v", "e.w")
        low = write_table(both.groupBy("v").agg(F.min("w").alias("m"), F.count("*").alias("d")).select("v", F.least("v", "m").alias("m"), "d"), "low")
        hot = [r.v for r in low.where(F.col("d") > max(HOT * n, LEAST_HOT)).collect()]
        large, seen = write_counted(hot_join(both.where("w > v"), low.drop("d"), "v", hot).select(F.col("w").alias("b"), F.col("m").alias("a")).distinct(), "large")
        # small star: v and its smaller neighbours go to the smallest of them; no vertex has more neighbours than here
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        hot = [r.b for r in large.groupBy("b").count().where(F.col("count") > max(HOT * seen["n"], LEAST_HOT)).collect()] if seen["n"] > LEAST_HOT else []
        new = hot_join(large, least, "b", hot).select(F.explode(F.array("a", "b")).alias("x"), "m").where("x <> m").select(F.col("m").alias("a"), F.col("x").alias("b")).distinct()
        new, seen = write_counted(new, "edges", h=F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
        drop_table(low, large, now)
        if state == seen:
            return new.select(F.col("b").alias("v"), F.col("a").alias("label"))
        now, state, n = new, seen, seen["n"]


def components(pairs: DataFrame, a: str = "a", b: str = "b", core: int = CORE) -> DataFrame:
    """``(record, group)`` of linked records, the group being the smallest of them."""
    e = pairs.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null and a <> b")
    edges, seen = write_counted(e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    now = write_table(contracted(edges, seen["n"], core), "labels")
    return now.select(F.col("v").alias("record"), F.col("label").alias("group")).unionByName(now.select(F.col("label").alias("record"), F.col("label").alias("group")).distinct())


def keeper(members: DataFrame, group: str, order: list) -> DataFrame:
    """Each member with the group's keeper: the first by a composite order."""
    w = Window.partitionBy(group).orderBy(*order)
    return members.withColumn("keeper_rank", F.row_number().over(w))


def decisions(pairs: DataFrame, decided: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs after human answers ``(a, b, verdict)``: ``same`` adds or keeps, ``different`` cuts. And unknown answers."""
    d = decided.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "verdict")
    joined = pairs.select("a", "b", F.lit(True).alias("_p")).join(d, ["a", "b"], "full_outer")
    kept = joined.where("verdict is null or verdict <> 'different'").select("a", "b", F.coalesce("verdict", F.lit("found")).alias("verdict"))
    return kept, joined.where("_p is null and verdict = 'different'").select("a", "b")


def moved(df: DataFrame, moves: DataFrame, columns: list[str]) -> DataFrame:
    """Paths rewritten by a table ``(old, new)``, in scalar and in array columns."""
    for c in columns:
        if df.schema[c].dataType.typeName() == "array":
            rows = df.withColumn("_row", F.monotonically_increasing_id())
            items = rows.select("_row", F.posexplode_outer(c).alias("_k", "old")).join(moves, "old", "left")
            nested = items.where("_k is not null").groupBy("_row").agg(F.transform(F.array_sort(F.collect_list(F.struct("_k", F.coalesce("new", "old").alias("v")))), lambda s: s["v"]).alias("_a"))
            df = rows.join(nested, "_row", "left").withColumn(c, F.coalesce("_a", c)).drop("_row", "_a")
        else:
            df = df.join(moves.select(F.col("old").alias("_old"), F.col("new").alias("_new")), F.col(c) == F.col("_old"), "left").withColumn(c, F.coalesce("_new", c)).drop("_old", "_new")
    return df
