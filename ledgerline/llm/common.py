"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import time

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path, ship_code, shuffle_partitions
from ..sources.fixtures import table

__all__ = ["BROADCAST_ROWS", "WS", "counted_broadcast", "discard", "materialize", "order_hash", "require",
           "ship_code", "shuffle_partitions", "table", "words_of"]

#: White space of the contracts: space and U+0009 to U+000D, as a Java character class.
WS = "[\\x20\\x09-\\x0D]+"
#: A side is broadcast only after it was counted to hold no more rows than this (rows of a few longs).
BROADCAST_ROWS = 200_000


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back with its own schema.

    Cuts the lineage and survives lost executors; an empty table reads back as empty.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._ll_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of :func:`materialize` that nothing reads any more, and the shuffle files that nothing does.

    Spark drops shuffle files when the driver collects its garbage, so it is asked to.
    """
    jvm = SparkContext._active_spark_context._jvm
    for df in tables:
        path = jvm.org.apache.hadoop.fs.Path(df._ll_path)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    # The gateway lets go of the driver's objects, and Spark of their files, a little later: once more after a pause.
    for _ in range(2):
        gc.collect()
        jvm.System.gc()
        time.sleep(0.5)


def counted_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` if its counted rows stay within ``limit``, else ``df`` (a shuffle join).

    Pass a materialized table: it is counted here and read again by the join.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def require(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; the table has {df.columns}")


def words_of(text: Column) -> Column:
    """Words of the contracts ``[^\\x20\\x09-\\x0D]+`` as an array; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WS), "")


def order_hash(*cols: Column) -> Column:
    """A 64-bit hash used to break ties and to deal rows out evenly."""
    return F.xxhash64(*cols)


def set_aside(df: DataFrame, names: tuple[str, ...]):
    """(``df`` with columns of these names renamed out of an operator's way, a function that names them back)."""
    clash = {c: f"_ll_aside_{i}" for i, c in enumerate(names) if c in df.columns}
    order = list(df.columns)

    def back(out: DataFrame) -> DataFrame:
        return out.select(*[F.col(f"`{clash.get(c, c)}`").alias(c) for c in order])

    return df.withColumnsRenamed(clash), back
