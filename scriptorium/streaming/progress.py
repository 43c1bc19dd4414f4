"""Structured Streaming over event logs: latest state per key, windowed counts, upserts. An extension: the batch
operators need none of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def progress(events: DataFrame, keys: list[str], at: str = "ts", value: str = "value") -> DataFrame:
    """Largest value and last time for each key; the same expression on a batch and on a stream (update mode)."""
    return events.groupBy(*keys).agg(F.max(value).alias("progress"), F.max(at).alias("opened"))


def windowed_counts(events: DataFrame, width: str, late: str, at: str = "ts") -> DataFrame:
    """Events per tumbling window and type; rows later than the watermark are dropped by a stream."""
    stamped = events.withColumn(at, F.col(at).cast("timestamp"))
    return stamped.withWatermark(at, late).groupBy(F.window(at, width), "event_type").agg(F.count("*").alias("n"))


def read(spark: SparkSession, folder: str, schema, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def upsert_stream(stream: DataFrame, path: str, checkpoint: str, keys: list[str]):
    """Keep the latest state per key in a Parquet folder: each batch is merged and written beside, then swapped in.

    Versions are numbered by batch, so a batch that is run again after a failure overwrites its own version only.
    """
    spark = stream.sparkSession

    def merge(batch: DataFrame, n: int) -> None:
        new = progress(batch, keys)
        old = spark.read.parquet(f"{path}/v{n - 1}") if n else None
        if old is not None:
            new = old.unionByName(new).groupBy(*keys).agg(F.max("progress").alias("progress"), F.max("opened").alias("opened"))
        new.write.mode("overwrite").parquet(f"{path}/v{n}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
