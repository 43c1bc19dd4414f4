"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SETTING = "spark.checkpoint.dir"
_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; without one, a folder of our own in local mode and an error on a cluster."""
    at = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if not at:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError(f"{SETTING} must name a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="scriptorium-")
        spark.conf.set(SETTING, at)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(at)
    return at


def keep_until_exit(spark: SparkSession, path: str) -> None:
    """A folder of our own that is deleted at exit."""
    _written.append((spark, path))


def write_table(df: DataFrame, label: str, codec: str = "lz4") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}.parquet"
    df.write.option("compression", codec).parquet(path)
    _written.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out.shared_path = path
    return out


def write_counted(df: DataFrame, label: str, **aggregates) -> tuple[DataFrame, dict]:
    """``write_table`` and, from the same job, aggregates of what was written by name; ``n`` counts the rows."""
    seen = Observation()
    out = write_table(df.observe(seen, F.count(F.lit(1)).alias("n"), *[x.alias(k) for k, x in aggregates.items()]), label)
    return out, seen.get


def hot_join(left: DataFrame, right: DataFrame, on: str, hot: list, how: str = "inner") -> DataFrame:
    """``left`` joined with the unique keys of ``right``; rows of the ``hot`` keys stay where they are.

    ``hot`` holds the keys that many rows of ``left`` share, few whatever the tables: their rows of ``right`` are
    broadcast, so that no task gets all rows of such a key.
    """
    if not hot:
        return left.join(right, on, how)
    is_hot = F.col(on).isin(hot)
    return left.where(is_hot).join(F.broadcast(right.where(is_hot)), on, how).unionByName(left.where(~is_hot).join(right, on, how))


def spread(df: DataFrame) -> DataFrame:
    """Rows of a table of few files over all cores, for work that costs more than moving them.

    A table of at least as many splits as there are cores is left as it is: nothing is moved at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def drop_table(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more."""
    for t in tables:
        path = getattr(t, "shared_path", None)
        if path:
            _delete(t.sparkSession, path)
            _written[:] = [x for x in _written if x[1] != path]


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        try:
            if not spark.sparkContext._jsc.sc().isStopped():
                _delete(spark, path)
        except Exception:  # the session is gone; its folder is the cluster's to clear
            return
