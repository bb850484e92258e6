"""Exact ranks inside groups of any size without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, order_hash

#: Rows that one rank window should hold.
WINDOW_ROWS = 20_000


def dense_rank_in(df: DataFrame, group: list[str], unique: list[str], name: str, rows: int, seed: int = 0) -> DataFrame:
    """Add ``name``: 0, 1, 2 ... within every group, in the order of a hash of the ``unique`` columns.

    ``df`` must be a written table (it is read twice) and ``unique`` must tell its rows apart.
    Every group is cut into sub-buckets by that hash; a sub-bucket's rows are numbered by a
    window and shifted by the sizes of the group's earlier sub-buckets. ``rows``: rows of the
    largest group; it sets the number of sub-buckets, so a window holds about WINDOW_ROWS.
    """
    n = max(1, -(-rows // WINDOW_ROWS))
    h = order_hash(*[F.col(c) for c in unique], F.lit(seed))
    cut = F.floor((F.shiftrightunsigned(h, 1).cast("double") / float(1 << 63)) * n).cast("int")
    d = df.withColumn("_ll_h", h).withColumn("_ll_cut", F.least(cut, F.lit(n - 1)))
    # n rows per group at most: their running sums are the offsets.
    sizes = d.groupBy(*group, "_ll_cut").agg(F.count(F.lit(1)).alias("_ll_n"))
    before = F.sum("_ll_n").over(Window.partitionBy(*group).orderBy("_ll_cut").rowsBetween(Window.unboundedPreceding, -1))
    offsets = materialize(sizes.select(*group, "_ll_cut", F.coalesce(before, F.lit(0)).alias("_ll_off")), "rank-offsets")
    at = F.row_number().over(Window.partitionBy(*group, "_ll_cut").orderBy("_ll_h", *unique))
    ranked = d.withColumn("_ll_at", at).join(offsets, [*group, "_ll_cut"])
    return ranked.withColumn(name, (F.col("_ll_off") + F.col("_ll_at") - 1).cast("long")).drop(
        "_ll_h", "_ll_cut", "_ll_at", "_ll_off")


def unsigned_crc32(text: Column) -> Column:
    return F.crc32(text.cast("binary"))
