"""Groups from pairwise matches (problem 2): connected components by reduction of the match graph.

Method.  Records become numbers once.  Each round takes an independent set of the vertices of degree one and two:
those drawn before all their neighbours by a hash drawn anew each round, which needs no join.  A taken vertex of degree
one is stripped; one of degree two is spliced out of its chain, its neighbours being joined (random-mate list ranking:
a chain or ring shrinks by a constant share each round).  Each taken vertex remembers the neighbour it hangs on.  The
core that is left, where hardly a degree is below three, is solved by itself.  Labels then go back to the taken
vertices: their parents form a forest, whose pointers are doubled until they reach vertices that were never taken.

Scale.  All tables are edges or (vertex, parent) pairs of numbers; rounds shrink geometrically, each is two writes to
the shared folder, whose jobs also count.  The edges of a hot vertex, and the members of a hot group, stay where they
are: what is joined to them is a broadcast of at most a thousand rows.  No vertex gains neighbours, so the hot ones are
known from the start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.linkage import CORE, HOT, LEAST_HOT, contracted
from ..shared import drop_table, hot_join, write_counted, write_table

#: Rounds of stripping; whatever is left after them belongs to the core, so the number decides only who does the work.
MAX_ROUNDS = 60
#: Stripping ends when a round takes fewer than one vertex in so many edges: the core's solver takes the rest.
WORTH = 20


def _edges(pairs: DataFrame) -> DataFrame:
    """Undirected simple edges ``a < b``."""
    return pairs.where("a is not null and b is not null and a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _both(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct(F.col("a").alias("v"), F.col("b").alias("w")), F.struct(F.col("b").alias("v"), F.col("a").alias("w")))).alias("e")).select("e.v", "e.w")


def connected_groups(pairs: DataFrame, a: str, b: str, rounds: int = MAX_ROUNDS, core: int = CORE) -> DataFrame:
    """``(record, group)`` for each record that ``pairs`` links to another one, directly or not.

    ``group`` is the smallest name, by code points, of all records of the component.  Nulls in either column, a
    record against itself, repeated rows and either order of a pair are allowed; records without a link to another
    one are not in the result; an empty table gives an empty result; other columns are ignored.
    """
    named, seen = write_counted(_edges(pairs.select(F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b"))), "named")
    left, most = seen["n"], max(HOT * seen["n"], LEAST_HOT)
    names = _both(named).groupBy("v").agg(F.count("*").alias("d")).withColumn("id", F.monotonically_increasing_id())
    names = write_table(names.select(F.col("v").alias("name"), "d", "id"), "names")
    heads = names.where(F.col("d") > most).select("name", "id").collect()
    called, hubs = [r.name for r in heads], [r.id for r in heads]
    edges = named
    for c in ("a", "b"):
        edges = hot_join(edges, names.select(F.col("name").alias(c), F.col("id").alias(f"{c}_id")), c, called)
    edges = write_table(edges.select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b")), "edges")
    drop_table(named)
    taken: list[DataFrame] = []
    for k in range(rounds if left else 0):
        near = _both(edges).groupBy("v").agg(F.count("*").alias("d"), F.min("w").alias("w1"), F.max("w").alias("w2"))
        draw = {c: F.xxhash64(c, F.lit(k)) for c in ("v", "w1", "w2")}
        low = ((F.col("d") <= 2) | (F.col("w1") == F.col("w2"))) & (draw["v"] < draw["w1"]) & (draw["v"] < draw["w2"])
        hub = F.col("v").isin(hubs) & (F.col("d") > 2) & (F.col("w1") != F.col("w2"))
        out, seen = write_counted(near.where(low | hub if hubs else low).withColumn("low", low), "taken", taken=F.count_if("low"))
        busy = [r.v for r in out.where("not low").select("v").collect()] if seen["n"] > seen["taken"] else []  # hubs that stay
        gone = out.where("low").select("v", "w1", "w2")
        rest = edges
        for c in ("a", "b"):
            cold = rest.where(~F.col(c).isin(busy)) if busy else rest
            kept = cold.join(gone.select(F.col("v").alias(c)), c, "left_anti")
            rest = kept.unionByName(rest.where(F.col(c).isin(busy))) if busy else kept
        spliced = gone.where("w1 <> w2").select(F.col("w1").alias("a"), F.col("w2").alias("b"))
        after = rest.select("a", "b").unionByName(spliced)
        worth = seen["taken"] * WORTH >= left
        after, seen = write_counted(after.distinct() if k % 2 else after, "edges")
        hung = gone.select("v", F.col("w1").alias("parent"))
        hung.shared_path = out.shared_path
        taken.append(hung)
        drop_table(edges)
        edges, left = after, seen["n"]
        if not worth or not left:
            break
    root = names.select("name", F.col("id").alias("v"))
    if taken:
        up = taken[0]
        for t in taken[1:]:
            up = up.unionByName(t)
        up = write_table(up, "parents")
        drop_table(*taken)
        reach = 1
        while reach < len(taken):  # a parent was taken in a later round, so no way up is longer than the rounds
            further = up.select(F.col("v").alias("parent"), F.col("parent").alias("over"))
            new = write_table(hot_join(up, further, "parent", hubs, "left").select("v", F.coalesce("over", "parent").alias("parent")), "parents")
            drop_table(up)
            up, reach = new, 2 * reach
        root = root.join(up, "v", "left").select("name", F.coalesce("parent", "v").alias("root"))
    else:
        root = root.select("name", F.col("v").alias("root"))
    root, seen = write_counted(root, "roots")
    if taken:
        drop_table(up)
    drop_table(names)
    # names of the groups: the smallest of each root, then of each label; hot ones are told by their size
    most = max(HOT * seen["n"], LEAST_HOT)
    best = root.groupBy("root").agg(F.min("name").alias("group"), F.count("*").alias("n"))
    if left:
        labels = contracted(edges, left, core)
        best = best.join(labels.select(F.col("v").alias("root"), "label"), "root", "left").select("root", F.coalesce("label", "root").alias("label"), "group", "n")
        best = write_table(best, "best")
        whole = best.groupBy("label").agg(F.min("group").alias("group"), F.count("*").alias("k"))
        whole = write_table(whole, "whole")
        hot = [r.label for r in whole.where(F.col("k") > most).select("label").collect()]
        best = hot_join(best.select("root", "label", "n"), whole.select("label", "group"), "label", hot)
    best = write_table(best.select("root", "group", "n"), "best")
    hot = [r.root for r in best.where(F.col("n") > most).select("root").collect()]
    return hot_join(root, best.select("root", "group"), "root", hot).select(F.col("name").alias("record"), "group")
