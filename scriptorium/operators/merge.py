"""Sinks as merges: no table format is needed, each gives the whole new table, to be written over the old one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_of(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in an explicit order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def insert_ignore(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Old rows stay; new ones come in where their key is not there yet."""
    return old.unionByName(new.join(old.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Insert, or update only the listed columns; all others survive."""
    o, n = old.alias("o"), new.alias("n")
    on = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]
    there = F.col(f"n.{keys[0]}").isNotNull()
    out = [F.coalesce(F.col(f"o.{k}"), F.col(f"n.{k}")).alias(k) for k in keys]
    for c in old.columns:
        if c in keys:
            continue
        known = c in new.columns
        fresh = F.col(f"o.{keys[0]}").isNull()
        if c in columns and known:
            out.append(F.when(there, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
        elif known:
            out.append(F.when(fresh, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
        else:
            out.append(F.col(f"o.{c}"))
    return o.join(n, on, "full_outer").select(*out)


def upsert_content(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Whole rows replaced."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)


def merge_map(old: DataFrame, new: DataFrame, keys: list[str], column: str) -> DataFrame:
    """A map column enriched by the entries of another table; its entries win."""
    n = new.select(*keys, F.col(column).alias("_new"))
    empty = F.create_map().cast(old.schema[column].dataType)
    merged = F.map_concat(F.map_filter(F.coalesce(column, empty), lambda k, _: ~F.coalesce(F.map_contains_key(F.coalesce("_new", empty), k), F.lit(False))), F.coalesce("_new", empty))
    return old.join(n, keys, "left").withColumn(column, merged).drop("_new")


def refs_upsert(old: DataFrame, scanned: DataFrame, found: DataFrame, present: DataFrame | None, key: str) -> DataFrame:
    """Scanned files get what was found now (nothing, if nothing was); files that vanished go; the rest stays."""
    kept = old.join(scanned.select(key), key, "left_anti")
    if present is not None:
        kept = kept.join(present.select(key), key, "left_semi")
    return kept.unionByName(found)


def override(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Right values win where there are any; columns and rows of either side are kept."""
    cols = list(dict.fromkeys([*left.columns, *right.columns]))
    l, r = left.alias("l"), right.alias("r")
    on = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in keys]
    pick = lambda c: F.coalesce(*([F.col(f"r.{c}")] if c in right.columns else []), *([F.col(f"l.{c}")] if c in left.columns else [])).alias(c)
    return l.join(r, on, "full_outer").select(*[pick(c) for c in cols])


def changed(old: DataFrame, new: DataFrame, keys: list[str], content: str) -> DataFrame:
    """Rows of ``new`` whose content differs from what is there: what a second run must not have."""
    o = old.select(*keys, F.sha2(F.col(content), 256).alias("_h"))
    return new.join(o, keys, "left").where(~F.sha2(F.col(content), 256).eqNullSafe(F.col("_h"))).drop("_h")


def quarantine(df: DataFrame, good) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy a condition, and the others (null counts as not)."""
    ok = F.coalesce(good, F.lit(False))
    return df.where(ok), df.where(~ok)


def edges(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct edges, rebuilt as a whole, so that none outlives its cause."""
    return df.select(*columns).dropDuplicates(columns)


def write_by_year(df: DataFrame, path: str, column: str = "year") -> None:
    df.write.mode("overwrite").partitionBy(column).parquet(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def diff_upload(local: DataFrame, remote: DataFrame) -> DataFrame:
    """``(key, md5)`` of what must be uploaded: not there, or with another checksum."""
    return local.join(remote.select("key", "md5"), ["key", "md5"], "left_anti")
