"""Queries by name, each with the SQL that gives the same rows, if SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: The latest reading of every path, as a common table expression for the SQL side.
WORKS = "works AS (SELECT * FROM markdown QUALIFY row_number() OVER (PARTITION BY path ORDER BY ingested_at DESC NULLS LAST, md_id DESC) = 1)"
VISIBLE = f"{WORKS}, visible AS (SELECT * FROM works WHERE status IS DISTINCT FROM 'draft' AND duplicate_of IS NULL)"


class Tables:
    """Tables of a folder by attribute; nothing is read before an action."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self._folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._folder}/{name}.parquet")

    @property
    def works(self) -> DataFrame:
        """The latest reading of every path."""
        from pyspark.sql import Window

        w = Window.partitionBy("path").orderBy(F.col("ingested_at").desc_nulls_last(), F.desc("md_id"))
        return self.markdown.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")

    @property
    def visible(self) -> DataFrame:
        """Works that are no drafts and no duplicates of others."""
        return self.works.where(~F.col("status").eqNullSafe("draft") & F.col("duplicate_of").isNull())

    @property
    def cited(self) -> DataFrame:
        """Distinct citation edges ``(path, ref_id)``."""
        return self.cites.where("path is not null and ref_id is not null").select("path", "ref_id").distinct()


def query(sql: str | None = None, name: str | None = None):
    """Register ``f(tables)`` under its name."""

    def put(f):
        key = name or f.__name__
        QUERIES[key] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            ORACLES[key] = sql
        return f

    return put
