"""Window-like operators: orders, runs, neighbours, pages, names that must be unique."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import hot_join, write_counted, write_table


def ranked(df: DataFrame, by: list[str], order: list) -> DataFrame:
    """``rank`` of each row in its group, from 1, where a group may be too large for one task.

    Rows are range-partitioned by group and order; a row's rank is its number in its partition's part of the group
    and the sizes of the parts before it.
    """
    placed = write_table(df.repartitionByRange(*by, *order).withColumn("_p", F.spark_partition_id()), "ranges")
    own = placed.withColumn("_k", F.row_number().over(Window.partitionBy("_p", *by).orderBy(*order)))
    sizes = placed.groupBy("_p", *by).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*by).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_p", *by, F.coalesce(before, F.lit(0)).alias("_o"))
    on = [own[c].eqNullSafe(offsets[c]) for c in ("_p", *by)]
    return own.join(offsets, on).select(*[own[c] for c in df.columns], (F.col("_k") + F.col("_o")).alias("rank"))


def paginate(df: DataFrame, order: list, size: int, by: list[str]) -> DataFrame:
    """Page number of each row in its group."""
    return ranked(df, by, order).withColumn("page", F.ceil(F.col("rank") / size).cast("int")).drop("rank")


def prev_next(df: DataFrame, group: str, order: list, id_col: str) -> DataFrame:
    """The item before and the one after each in its group, however large that is: ranks, joined with their neighbours."""
    rows = write_table(ranked(df, [group], order), "ranked")
    near = [rows.select(group, F.col(id_col).alias(name), (F.col("rank") + step).alias("rank")) for name, step in (("previous", 1), ("next", -1))]
    return rows.join(near[0], [group, "rank"], "left").join(near[1], [group, "rank"], "left").drop("rank")


def next_circular(df: DataFrame, group: str, order: list, id_col: str, n: int = 2) -> DataFrame:
    """The ``n`` items after each in its group, wrapping round; never itself."""
    rows, seen = write_counted(ranked(df, [group], order).select(group, id_col, (F.col("rank") - 1).alias("k")), "ranked")
    sizes = write_table(rows.groupBy(group).agg(F.count("*").alias("m")), "sizes")
    hot = [r[0] for r in sizes.where(F.col("m") > max(seen["n"] / 500, 10_000)).select(group).collect()]  # 500 at most
    want = hot_join(rows, sizes, group, hot).where("m > 1").select(group, id_col, "k", "m", F.explode(F.sequence(F.lit(1), F.least(F.lit(n), F.greatest(F.col("m") - 1, F.lit(1))))).alias("step"))
    to = rows.select(group, F.col(id_col).alias("follower"), "k")
    return want.withColumn("k", F.pmod(F.col("k") + F.col("step"), F.col("m"))).join(to, [group, "k"]).select(group, id_col, F.col("step").cast("int").alias("step"), "follower")


def part_number(df: DataFrame, group: str, explicit: str, day: str, id_col: str) -> DataFrame:
    """Parts 1..n: by their explicit number first, then by date (unknown last), then by id: a total order."""
    return ranked(df, [group], [F.col(explicit).asc_nulls_last(), F.col(day).asc_nulls_last(), F.col(id_col)]).withColumnRenamed("rank", "part")


def slug_suffix(df: DataFrame, token: str, order: list) -> DataFrame:
    """Tokens that come again get ``_2``, ``_3``, … in order."""
    w = Window.partitionBy(token).orderBy(*order)
    k = F.row_number().over(w)
    return df.withColumn("unique_token", F.when(k == 1, F.col(token)).otherwise(F.concat(F.col(token), F.lit("_"), k.cast("string"))))


def hash_suffix(df: DataFrame, token: str, source: str, order: list) -> DataFrame:
    """Tokens that come again get eight hex digits of the SHA-256 of what they came from."""
    w = Window.partitionBy(token).orderBy(*order)
    return df.withColumn("unique_token", F.when(F.row_number().over(w) == 1, F.col(token)).otherwise(F.concat(F.col(token), F.lit("_"), F.substring(F.sha2(F.col(source), 256), 1, 8))))


def name_levels(df: DataFrame, levels: list[Column]) -> DataFrame:
    """The first of several ever longer names that no other row has; null (an error to report) if none is."""
    rows = df
    for k, c in enumerate(levels):
        rows = rows.withColumn(f"_l{k}", c)
        rows = rows.withColumn(f"_n{k}", F.count("*").over(Window.partitionBy(f"_l{k}")))
    pick = F.coalesce(*[F.when((F.col(f"_n{k}") == 1) & F.col(f"_l{k}").isNotNull(), F.col(f"_l{k}")) for k in range(len(levels))])
    level = F.coalesce(*[F.when((F.col(f"_n{k}") == 1) & F.col(f"_l{k}").isNotNull(), F.lit(k)) for k in range(len(levels))])
    return rows.withColumn("file_name", pick).withColumn("level", level).drop(*[f"_{x}{k}" for k in range(len(levels)) for x in "ln"])


def ascending_run(numbers: Column) -> Column:
    """The numbers from the first on as long as they grow."""
    start = F.struct(F.array().cast("array<int>").alias("kept"), F.lit(-(2**31)).alias("last"), F.lit(True).alias("on"))
    step = lambda s, x: F.when(s["on"] & (x > s["last"]), F.struct(F.concat(s["kept"], F.array(x)).alias("kept"), x.alias("last"), F.lit(True).alias("on"))).otherwise(F.struct(s["kept"].alias("kept"), s["last"].alias("last"), F.lit(False).alias("on")))
    return F.aggregate(numbers, start, step, lambda s: s["kept"])


def nonoverlapping(spans: Column) -> Column:
    """Of spans ``index, text, ref`` in order, longer first where two begin together, those outside all before them."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["index"].alias("index"), (-F.length(s["text"])).alias("n"), s["text"].alias("text"), s["ref"].alias("ref"))))
    start = F.struct(F.slice(ordered, 1, 0).alias("kept"), F.lit(-1).alias("end"))
    step = lambda a, s: F.when(s["index"] >= a["end"], F.struct(F.concat(a["kept"], F.array(s)).alias("kept"), (s["index"] - s["n"]).alias("end"))).otherwise(a)
    return F.aggregate(ordered, start, step, lambda a: a["kept"])
