"""Exploration and data-quality operators.

Everything is one or two aggregations over the whole table; wide per-column statistics are
computed in a single pass by unpivoting columns into (column, value) rows first, so the
work is spread over (column, value) groups rather than one group per column. Exact
quantiles work on value counts instead of ``percentile`` (which holds a whole group's
values in one task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import c, parse_double
from ..session import freeze, shuffle_partitions

LABEL = "Is Laundering"
# Largest per-group table broadcast in exact quantiles (rows = groups x ranges x quantiles, five numbers each).
MAX_BROADCAST_GROUPS = 200_000


def _melt(df: DataFrame, columns: list[str], keep: list[str] | None = None, cast: str = "string") -> DataFrame:
    """(keep..., column, value) rows: one per cell of ``columns``."""
    keep = keep or []
    arr = F.array(*[F.struct(F.lit(x).alias("column"), c(x).cast(cast).alias("value")) for x in columns])
    return df.select(*[c(k) for k in keep], F.inline(arr))


def cardinality(df: DataFrame, columns: list[str], approx: bool = False) -> DataFrame:
    """A1: distinct non-null values per column, one row per column."""
    m = _melt(df, columns).where(F.col("value").isNotNull())
    if approx:
        return m.groupBy("column").agg(F.approx_count_distinct("value").cast("long").alias("n_distinct"))
    # distinct (column, value) first: a partial aggregate, then a count per column
    return m.distinct().groupBy("column").agg(F.count(F.lit(1)).cast("long").alias("n_distinct"))


def value_counts(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Counts per value (NULLs excluded), optionally per slice ``by``."""
    by = by or []
    m = _melt(df, columns, keep=by).where(F.col("value").isNotNull())
    return m.groupBy(*[c(b) for b in by], "column", "value").agg(F.count(F.lit(1)).cast("long").alias("count"))


def slice_by_label(df: DataFrame, label: str = LABEL, value="1") -> DataFrame:
    """rows of one label."""
    return df.where(c(label) == F.lit(value))


def exact_quantiles(long_df: DataFrame, group: list[str], value: str, qs: list[float]) -> DataFrame:
    """Exact (linear-interpolated, like pandas/DuckDB ``quantile_cont``) quantiles per group.

    Works on (group, value) counts: equal values are combined before the shuffle, so a value
    that fills a column is one row. The distinct values are range-partitioned, running counts
    inside a range are shifted by the counts of the group's earlier ranges, and the values whose
    span of ranks holds the wanted ranks are picked.
    """
    counts = long_df.where(F.col(value).isNotNull()).groupBy(*group, F.col(value).cast("double").alias("_ll_x")).agg(
        F.count(F.lit(1)).alias("_ll_c"))
    n_ranges = shuffle_partitions(long_df.sparkSession)
    counts = freeze(counts.repartitionByRange(n_ranges, *group, "_ll_x").withColumn("_ll_p", F.spark_partition_id()),
                    "value-counts")
    sums = freeze(counts.groupBy(*group, "_ll_p").agg(F.sum("_ll_c").alias("_ll_t")), "range-counts")
    before = Window.partitionBy(*group).orderBy("_ll_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*group, "_ll_p", F.coalesce(F.sum("_ll_t").over(before), F.lit(0)).alias("_ll_o"))
    spans = sums.groupBy(*group).agg(F.sum("_ll_t").alias("_ll_n"))
    h = (F.col("_ll_n") - 1) * F.col("q")
    want = spans.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in qs]))).select(
        *group, "q", F.floor(h).alias("_ll_lo"), F.least(F.floor(h) + 1, F.col("_ll_n") - 1).alias("_ll_hi"),
        (h - F.floor(h)).alias("_ll_f"))
    if sums.count() * max(1, len(qs)) <= MAX_BROADCAST_GROUPS:
        offsets, want = F.broadcast(offsets), F.broadcast(want)
    inside = Window.partitionBy("_ll_p", *group).orderBy("_ll_x").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_ll_c").over(inside), F.lit(0))
    placed = counts.withColumn("_ll_s", start).join(offsets, [*group, "_ll_p"]).withColumn(
        "_ll_s", F.col("_ll_s") + F.col("_ll_o")).withColumn("_ll_e", F.col("_ll_s") + F.col("_ll_c"))

    def holds(rank: str):
        return (F.col(rank) >= F.col("_ll_s")) & (F.col(rank) < F.col("_ll_e"))

    hits = placed.join(want, group).where(holds("_ll_lo") | holds("_ll_hi"))
    ends = hits.groupBy(*group, "q").agg(F.max(F.when(holds("_ll_lo"), F.col("_ll_x"))).alias("_ll_a"),
                                         F.max(F.when(holds("_ll_hi"), F.col("_ll_x"))).alias("_ll_b"),
                                         F.max("_ll_f").alias("_ll_f"))
    return ends.select(*group, "q", (F.col("_ll_a") + (F.col("_ll_b") - F.col("_ll_a")) * F.col("_ll_f")).alias("value"))


def amount_summary(df: DataFrame, columns: list[str], label: str = LABEL) -> DataFrame:
    """A3: min / max / mean / median of each amount column per label value."""
    m = _melt(df, columns, keep=[label], cast="double").withColumnRenamed(label, "label")
    basic = m.groupBy("label", "column").agg(F.min("value").alias("min"), F.max("value").alias("max"),
                                             F.avg("value").alias("mean"))
    med = exact_quantiles(m, ["label", "column"], "value", [0.5]).select("label", "column", F.col("value").alias("median"))
    return basic.join(med, ["label", "column"], "left")


def null_counts(df: DataFrame) -> DataFrame:
    """NULL cells per column, all columns in one pass."""
    row = df.agg(*[F.count_if(c(x).isNull()).cast("long").alias(x) for x in df.columns])
    return _melt(row, df.columns, cast="long").withColumnRenamed("value", "n_null")


def info(df: DataFrame) -> DataFrame:
    """Column name, position, type and non-null count."""
    spark = df.sparkSession
    types = spark.createDataFrame([(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)],
                                  "position int, column string, type string")
    nn = df.agg(*[F.count(c(x)).cast("long").alias(x) for x in df.columns])
    nn = _melt(nn, df.columns, cast="long").withColumnRenamed("value", "non_null")
    return types.join(F.broadcast(nn), "column")  # one row per column on both sides


def describe_strings(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A5 (text columns): count, unique, top (most frequent; ties -> smallest value), freq."""
    columns = columns or df.columns
    vc = value_counts(df, columns)
    # top: highest count, ties broken by the smallest value
    return vc.groupBy("column").agg(
        F.sum("count").cast("long").alias("count"),
        F.count(F.lit(1)).cast("long").alias("unique"),
        F.min_by(F.col("value"), F.struct(-F.col("count"), F.col("value"))).alias("top"),
        F.max("count").cast("long").alias("freq"))


def describe_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """A5 (numeric columns): count, mean, std (sample), min, 25 %, 50 %, 75 %, max."""
    m = _melt(df, columns, cast="double")
    basic = m.groupBy("column").agg(
        F.count("value").cast("long").alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    qs = exact_quantiles(m, ["column"], "value", [0.25, 0.5, 0.75])
    wide = qs.groupBy("column").agg(*[F.max(F.when(F.col("q") == q, F.col("value"))).alias(n)
                                      for q, n in [(0.25, "p25"), (0.5, "p50"), (0.75, "p75")]])
    return basic.join(wide, "column", "left")


def find_negative(df: DataFrame, columns: list[str], key: str = "row_id") -> DataFrame:
    """(key, column, value) for every cell that parses to a negative number."""
    m = _melt(df, columns, keep=[key])
    return m.where(parse_double("value") < 0)


def find_nulls(df: DataFrame, key: str = "row_id") -> DataFrame:
    """(key, column) for every NULL cell."""
    cols = [x for x in df.columns if x != key]
    return _melt(df, cols, keep=[key]).where(F.col("value").isNull()).select(key, "column")


def clean(df: DataFrame) -> DataFrame:
    """drop rows with any missing value."""
    keep = None
    for x in df.columns:
        keep = c(x).isNotNull() if keep is None else keep & c(x).isNotNull()
    return df.where(keep)


QUALITY_COUNTS = ["n_null", "n_negative", "n_malformed"]


def quality_metrics(df: DataFrame, amount_columns: list[str], ts_column: str = "Timestamp", ts_parser=None,
                    key: str = "row_id") -> tuple[list[str], list[Column]]:
    """(checked columns, the counts of each as aggregates named ``<column>|<count>``)."""
    from ..functions.scalar import parse_ts
    ts_parser = ts_parser or parse_ts
    cols = [x for x in df.columns if x != key]
    aggs = []
    for x in cols:
        if x in amount_columns:
            neg, bad = parse_double(x) < 0, parse_double(x).isNull()
        elif x == ts_column:
            neg, bad = F.lit(False), ts_parser(x).isNull()
        else:
            neg, bad = F.lit(False), F.lit(False)
        aggs += [F.count_if(c(x).isNull()).cast("long").alias(f"{x}|n_null"),
                 F.count_if(F.coalesce(neg, F.lit(False))).cast("long").alias(f"{x}|n_negative"),
                 F.count_if(c(x).isNotNull() & bad).cast("long").alias(f"{x}|n_malformed")]
    return cols, aggs


def quality_report(df: DataFrame, amount_columns: list[str], ts_column: str = "Timestamp",
                   ts_parser=None, key: str = "row_id") -> DataFrame:
    """Q7: per column, in one pass: NULL cells, negative amounts, unparseable values."""
    cols, aggs = quality_metrics(df, amount_columns, ts_column, ts_parser, key)
    arr = F.array(*[F.struct(F.lit(x).alias("column"), *[F.col(f"`{x}|{n}`").alias(n) for n in QUALITY_COUNTS]) for x in cols])
    return df.agg(*aggs).select(F.inline(arr))


def score_summary(df: DataFrame, pred: str = "Is_Laundering_Prediction") -> DataFrame:
    """Predicted-positive count and row count."""
    return df.agg(F.count_if(F.col(pred) == 1).cast("long").alias("n_flagged"),
                  F.count(F.lit(1)).cast("long").alias("n_rows"))


def flagged(df: DataFrame, pred: str = "Is_Laundering_Prediction") -> DataFrame:
    """rows predicted positive."""
    return df.where(F.col(pred) == 1)
