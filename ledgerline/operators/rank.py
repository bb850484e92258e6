"""Distributed global ordering: row index (P9), rank of unique keys (W1), ordered head (O3).

``row_number()`` over an un-partitioned window moves every row into one task. Two
distributed replacements live here:

* :func:`with_row_index` - any total order. Range-partition on the order, cut the lineage
  by writing the rows with (partition id, position) to the shared checkpoint folder
  (range bounds are sampled, so a recomputation after a lost executor could otherwise
  move rows between partitions), count rows per partition (one number per partition
  reaches the driver), then add the partition's offset to the position. No shuffle after
  the range exchange.
* :func:`rank_unique` - the order column is a unique integer (a position). Rows are put in
  fixed-width value buckets, so every bucket holds at most ``bucket_width`` rows whatever
  the data skew; offsets of the buckets come from a small aggregate. Fully deterministic,
  no checkpoint needed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path, shuffle_partitions

DEFAULT_BUCKET_WIDTH = 1 << 20
# Largest offsets table joined by broadcast; its size is bounded by the bucket count.
MAX_BROADCAST_BUCKETS = 2_000_000


def _cols(order_by) -> list[Column]:
    if isinstance(order_by, (str, Column)):
        order_by = [order_by]
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


def with_row_index(df: DataFrame, order_by, name: str = "row_id", num_partitions: int | None = None,
                   start: int = 0, return_count: bool = False, post=None):
    """Add a dense 0-based (or ``start``-based) long index following ``order_by``.

    ``order_by`` must be a total order (ties get an arbitrary but consistent order).
    The range-partitioned rows are written once, with their partition id and position, to
    a table in the shared checkpoint folder; the index is computed from that table only,
    so re-running any task later cannot change it. ``post`` (a ``DataFrame -> DataFrame``
    step that keeps the ``_ll_pid``/``_ll_pos`` columns) runs inside the parallel write stage,
    e.g. to build derived columns once instead of in every consumer; if it drops or repeats
    rows, the index is dense over what it leaves.
    """
    spark = df.sparkSession
    cols = _cols(order_by)
    n = num_partitions or shuffle_partitions(spark)
    ranged = df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
    pid = F.spark_partition_id().cast("long")
    tagged = ranged.withColumn("_ll_pid", pid).withColumn(
        "_ll_pos", F.monotonically_increasing_id() - F.shiftleft(pid, 33))
    if post is not None:
        tagged = post(tagged)
    path = scratch_path(spark, "row-index")
    tagged.write.mode("errorifexists").parquet(path)
    frozen = spark.read.parquet(path)
    found = frozen.groupBy("_ll_pid").agg(F.count(F.lit(1)).alias("n"), F.max("_ll_pos").alias("top")).collect()
    counts = {r["_ll_pid"]: r["n"] for r in found}  # two numbers per partition
    if any(r["top"] + 1 != r["n"] for r in found):  # ``post`` dropped or repeated rows: number what it left
        frozen = frozen.withColumn("_ll_pos", F.row_number().over(
            Window.partitionBy("_ll_pid").orderBy("_ll_pos")).cast("long") - 1)
    offsets, acc = [], start
    for p in range(max(counts, default=-1) + 1):
        offsets.append(acc)
        acc += counts.get(p, 0)
    if not offsets:
        out = frozen.drop("_ll_pid", "_ll_pos").withColumn(name, F.lit(None).cast("long"))
    else:
        offset_arr = F.array(*[F.lit(o).cast("long") for o in offsets])
        out = frozen.withColumn(name, F.element_at(offset_arr, F.col("_ll_pid").cast("int") + 1) + F.col("_ll_pos"))
        out = out.drop("_ll_pid", "_ll_pos")
    return (out, acc - start) if return_count else out


def rank_unique(df: DataFrame, col: str, name: str = "rank", start: int = 0,
                bucket_width: int = DEFAULT_BUCKET_WIDTH, bounds: tuple[int, int] | None = None) -> DataFrame:
    """Dense rank of rows by a column whose non-null values are unique integers.

    Returns ``df`` plus ``name`` (long, ``start``-based). The work is split into value
    buckets of ``bucket_width``; no bucket can hold more rows than that.
    """
    if bounds is None:
        lo, hi = df.agg(F.min(col), F.max(col)).first()
    else:
        lo, hi = bounds
    if lo is None:
        return df.withColumn(name, F.lit(None).cast("long"))
    n_buckets = max(1, math.ceil((hi - lo + 1) / bucket_width))
    bucket = F.floor((F.col(col) - F.lit(lo)) / F.lit(bucket_width)).cast("long")
    bucketed = df.withColumn("_ll_bucket", bucket)
    w = Window.partitionBy("_ll_bucket").orderBy(F.col(col))
    b = bucketed.withColumn("_ll_pos", F.row_number().over(w).cast("long"))
    sizes = bucketed.groupBy("_ll_bucket").agg(F.count(F.lit(1)).alias("_ll_n"))
    # Prefix sums over at most n_buckets rows (bounded by the value range / width).
    offs = sizes.withColumn(
        "_ll_off",
        F.coalesce(F.sum("_ll_n").over(Window.orderBy("_ll_bucket").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).cast("long"),
    ).drop("_ll_n")
    if n_buckets <= MAX_BROADCAST_BUCKETS:
        offs = F.broadcast(offs)
    out = b.join(offs, "_ll_bucket").withColumn(name, F.col("_ll_off") + F.col("_ll_pos") - 1 + F.lit(start))
    return out.drop("_ll_bucket", "_ll_pos", "_ll_off")


def head_by_index(df: DataFrame, n: int, index: str = "row_id") -> DataFrame:
    """Deterministic head-n (O3): the first ``n`` rows of a table with a dense 0-based index, as a filter."""
    return df.where(F.col(index) < n)
