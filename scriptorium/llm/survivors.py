"""Best representative of each duplicate group (problem 6), by currency reasoning.

Method.  Every group is a partial order: row ``x`` stands over row ``y`` if it beats it in one respect (completeness,
editorial pass, trust of the source) and is beaten in none.  The unique top of that order survives.  For a record
built field by field, the order of values over time is learned from all groups with timestamps: ``v -> w`` counts
how often ``w`` followed ``v`` in one group.  The learned steps are closed by a topological order (cycles lose their
least supported steps); where a group has no timestamps, the value of its that comes last in that order is taken, which
no other value of the group is known to follow.

Scale.  Rows of a group are reduced to counts per standing before they meet, so a group of a third of all rows is a
few rows per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import drop_table, write_counted, write_table

COMPLETE = ["title", "subtitle", "date", "location", "preacher", "summary", "tags", "persons", "places", "bible_refs"]
WORST_TRUST = 2147483647


def completeness(df: DataFrame, fields: list[str]) -> Column:
    """How many fields are neither null nor empty."""
    parts = []
    for f in fields:
        full = F.size(f) > 0 if df.schema[f].dataType.typeName() == "array" else F.length(f) > 0
        parts.append(F.coalesce(full.cast("int"), F.lit(0)))
    return sum(parts[1:], parts[0])


def standings(df: DataFrame, sources: DataFrame, id_col: str = "md_id", fields: list[str] | None = None) -> DataFrame:
    """``(group_key, id, full, edited, trust)``: larger ``full`` and ``edited``, smaller ``trust`` are better.

    A null ``editorial_pass`` is the worst; a source without trust, or none, is the least trusted.
    """
    trust = sources.groupBy("source").agg(F.min("trust").alias("trust"))  # repeated rows must not multiply documents
    rows = df.select(F.coalesce("duplicate_of", "path").alias("group_key"), F.col(id_col).alias("id"), completeness(df, fields or COMPLETE).alias("full"), F.coalesce("editorial_pass", F.lit("")).alias("edited"), "source")
    return rows.where("group_key is not null").join(trust, "source", "left").select("group_key", "id", "full", "edited", F.coalesce("trust", F.lit(WORST_TRUST)).alias("trust"))


def tops(standing: DataFrame) -> DataFrame:
    """``(group_key, id, n)``: groups of ``n >= 2`` rows with exactly one row that no other row beats in any respect.

    Rows that tie in all three respects leave a group without a top, as do groups whose best values lie in different
    rows.  Groups of one row and rows without a key are not in the result.
    """
    place = F.struct(F.col("full"), F.col("edited"), (-F.col("trust")).alias("trusted"))
    level = standing.withColumn("place", place).groupBy("group_key", "place").agg(F.count("*").alias("n"), F.min("id").alias("id"))
    top = level.groupBy("group_key").agg(F.sum("n").alias("n"), F.max(F.struct("place", F.col("n").alias("ties"), "id")).alias("top"), F.max("place.full").alias("full"), F.max("place.edited").alias("edited"), F.max("place.trusted").alias("trusted"))
    best = (F.col("top.place.full") == F.col("full")) & (F.col("top.place.edited") == F.col("edited")) & (F.col("top.place.trusted") == F.col("trusted"))
    return top.where((F.col("n") > 1) & (F.col("top.ties") == 1) & best).select("group_key", F.col("top.id").alias("id"), "n")


def transitions(rows: DataFrame, group: str, value: str, at: str, kind: str | None = None) -> DataFrame:
    """Learned precedence ``(kind, earlier, later, n, against)`` of values, from rows that carry a timestamp.

    Values of different ``kind`` (fields, say) have nothing to do with each other.  Equal timestamps in a group say
    nothing and are skipped; null values are no values.
    """
    k = F.col(kind) if kind else F.lit("")
    kept = rows.where(F.col(group).isNotNull() & F.col(value).isNotNull() & F.col(at).isNotNull()).groupBy(k.alias("kind"), F.col(group).alias("g"), F.col(value).cast("string").alias("v")).agg(F.max(at).alias("t"))
    w = Window.partitionBy("kind", "g").orderBy("t", "v")
    steps = kept.select("kind", F.lag("v").over(w).alias("earlier"), F.col("v").alias("later"), F.lag("t").over(w).alias("t0"), "t").where("earlier is not null and t0 < t").groupBy("kind", "earlier", "later").agg(F.count("*").alias("n"))
    back = steps.select("kind", F.col("earlier").alias("later"), F.col("later").alias("earlier"), F.col("n").alias("against"))
    return steps.join(back, ["kind", "earlier", "later"], "left").select("kind", "earlier", "later", "n", F.coalesce("against", F.lit(0)).alias("against")).where("n > against")


def levels(learned: DataFrame) -> DataFrame:
    """``(kind, v, level)``: a topological order of all values with a learned precedence.

    A value's level is above those of all values that it follows, directly or through others, so the value of the
    highest level of a group is one that no other value of the group is known to follow.  Level by level the values
    that follow nothing left are taken away; where only cycles are left, their least supported steps are given up.
    """
    edges, seen = write_counted(learned.select("kind", "earlier", "later", (F.col("n") - F.col("against")).alias("n")), "steps", least=F.min("n"))
    out, k = None, 0
    while seen["n"]:
        open_ = edges.select("kind", F.col("later").alias("v"))
        first, taken = write_counted(edges.select("kind", F.col("earlier").alias("v")).distinct().join(open_, ["kind", "v"], "left_anti").withColumn("level", F.lit(k)), "level")
        if taken["n"]:
            ends = first.select("kind", F.col("v").alias("earlier"))
            rest = edges.join(ends, ["kind", "earlier"], "left_anti")
            # what only the taken ones came before has nothing left to follow, and may come before nothing
            last = edges.join(ends, ["kind", "earlier"], "left_semi").select("kind", F.col("later").alias("v"), F.lit(k + 1).alias("level")).distinct()
            last = write_table(last.join(rest.select("kind", F.col("earlier").alias("v")).unionByName(rest.select("kind", F.col("later").alias("v"))), ["kind", "v"], "left_anti"), "level")
            out = first.unionByName(last) if out is None else out.unionByName(first).unionByName(last)
            k += 1
        else:
            rest = edges.where(F.col("n") > seen["least"])
            drop_table(first)
        new, seen = write_counted(rest, "steps", least=F.min("n"))
        drop_table(edges)
        edges = new
    if out is None:
        return learned.select("kind", F.col("earlier").alias("v"), F.lit(0).alias("level")).limit(0)
    return out.groupBy("kind", "v").agg(F.max("level").alias("level"))


def latest_values(rows: DataFrame, group: str, value: str, at: str, learned: DataFrame, kind: str | None = None) -> DataFrame:
    """``(kind, group, value)``: the current value of each group, and of each ``kind`` in it, that has any.

    With timestamps the latest non-null value; in a group without any, the topologically latest one under the learned
    precedence; ties go to the more frequent, then the smaller value.
    """
    k = F.col(kind) if kind else F.lit("")
    kept = rows.where(F.col(group).isNotNull() & F.col(value).isNotNull()).groupBy(k.alias("kind"), F.col(group).alias("g"), F.col(value).cast("string").alias("v")).agg(F.max(at).alias("t"), F.count("*").alias("k"))
    kept = write_table(kept, "values")
    # smaller values win ties: of those with the same best order the least is taken
    timed = kept.where("t is not null")
    known = timed.select("kind", "g").distinct()
    untimed = kept.where("t is null").join(known, ["kind", "g"], "left_anti")

    def best(df: DataFrame, order: Column) -> DataFrame:
        per = df.groupBy("kind", "g", order.alias("o")).agg(F.min("v").alias("v"))
        return per.groupBy("kind", "g").agg(F.max_by("v", "o").alias("v"))

    out = best(timed, F.struct("t", "k"))
    if not untimed.isEmpty():
        placed = untimed.join(levels(learned), ["kind", "v"], "left")
        out = out.unionByName(best(placed, F.struct(F.coalesce("level", F.lit(-1)), F.col("k"))))
    return out.select("kind", F.col("g").alias(group), F.col("v").alias(value))


def golden(df: DataFrame, sources: DataFrame, fields: list[str], at: str = "ingested_at") -> DataFrame:
    """One built record for each group: ``group_key, id`` (of the best row) and each field's current value as text."""
    standing = standings(df, sources)
    order = F.struct("full", "edited", (-F.col("trust")).alias("x"), (-F.col("id")).alias("y"))
    out = standing.groupBy("group_key").agg(F.max_by("id", order).alias("id"), F.count("*").alias("n"))
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])).alias("f")
    rows = df.select(F.coalesce("duplicate_of", "path").alias("key"), F.col(at).alias("at"), each).select("key", "at", "f.field", "f.value")
    rows = write_table(rows.where("key is not null and value is not null").groupBy("key", "field", "value", "at").agg(F.count("*").alias("n")), "unpivoted")
    now = latest_values(rows, "key", "value", "at", transitions(rows, "key", "value", "at", "field"), "field")
    wide = now.groupBy("key").pivot("kind", fields).agg(F.first("value"))
    return out.join(wide.withColumnRenamed("key", "group_key"), "group_key", "left")
