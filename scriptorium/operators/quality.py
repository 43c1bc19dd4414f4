"""Checks of the engine's own outputs; each gives the offending rows, none when all is well."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unresolved(links: DataFrame, col: str, targets: DataFrame, target: str) -> DataFrame:
    """Links whose target is not there."""
    return links.join(targets.select(F.col(target).alias(col)).distinct(), col, "left_anti")


def missing(expected: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    return expected.select(*keys).distinct().join(present.select(*keys), keys, "left_anti")


def forbidden(present: DataFrame, banned: DataFrame, keys: list[str]) -> DataFrame:
    return present.select(*keys).distinct().join(banned.select(*keys), keys, "left_semi")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that come more than once, with how often."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def invalid_json(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull() & F.try_parse_json(F.col(col)).isNull())


def invalid_dates(df: DataFrame, col: str) -> DataFrame:
    """Values that are no day, month or year."""
    return df.where(F.col(col).isNotNull() & ~F.col(col).rlike(r"^\d{4}(?:-(?:0[1-9]|1[0-2])(?:-(?:0[1-9]|[12]\d|3[01]))?)?$"))


def over_limit(df: DataFrame, size: Column, most: int) -> DataFrame:
    return df.where(size > most)


def same(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one of two runs has."""
    return a.exceptAll(b).unionByName(b.exceptAll(a))
