"""Running profile: statistics that are merged batch by batch, without reading earlier batches again (A1, Q1, Q4, K7).

A batch leaves one row per feature: counts, sums of a kind that can be merged (n, mean, squared deviations), extremes,
and two sketches, HyperLogLog for distinct values and KLL for quantiles. All of them come from one aggregate over
the batch, and merging is an aggregate over those few rows, so a profile of any number of batches costs
batches x features rows. Counts, extremes, means and deviations are exact (up to rounding of sums);
distinct counts are within about 1.6 % (one standard error) and quantiles within about 1.65 % of the rank.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import c
from .quality import STAT_DECIMALS, split_features

SCHEMA = ("feature string, kind string, n long, missing long, zeros long, mean double, m2 double, low double, high double, "
          "letters long, distinct binary, ranks binary")


def batch_sketches(df: DataFrame, exclude: list[str] | None = None) -> DataFrame:
    """One row per numeric and text feature of a batch (``SCHEMA``); one aggregate over the batch."""
    num, txt = split_features(df, exclude)
    aggs, rows = [], []
    for i, x in enumerate([*num, *txt]):
        number = x in num
        v = c(x).cast("double") if number else c(x)
        null = F.lit(None)
        parts = {
            "n": F.count(v), "missing": F.count_if(v.isNull()), "zeros": F.count_if(v == 0) if number else null.cast("long"),
            "mean": F.avg(v) if number else null.cast("double"),
            "m2": F.var_pop(v) * F.count(v) if number else null.cast("double"),
            "low": F.min(v) if number else null.cast("double"), "high": F.max(v) if number else null.cast("double"),
            "letters": F.sum(F.length(v)) if not number else null.cast("long"),
            "distinct": F.hll_sketch_agg(c(x).cast("string")),
            "ranks": F.kll_sketch_agg_double(v) if number else null.cast("binary"),
        }
        aggs += [e.alias(f"{i}|{k}") for k, e in parts.items()]
        rows.append(F.struct(F.lit(x).alias("feature"), F.lit("num" if number else "str").alias("kind"),
                             *[F.col(f"`{i}|{k}`").alias(k) for k in parts]))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def add_batch(df: DataFrame, root: str, batch_id: int, exclude: list[str] | None = None) -> None:
    """K7: store a batch's sketches; a replayed batch replaces its own."""
    batch_sketches(df, exclude).coalesce(1).write.mode("overwrite").parquet(os.path.join(root, f"batch_id={batch_id}"))


def stored(spark: SparkSession, root: str) -> DataFrame:
    """The sketch rows of all batches, with their ``batch_id``."""
    return spark.read.schema(SCHEMA + ", batch_id long").parquet(root)


def merge(rows: DataFrame) -> DataFrame:
    """Sketch rows of several batches as one row per feature, again a row that can be merged."""
    n = F.sum("n")
    mean = F.try_divide(F.sum(F.col("n") * F.col("mean")), n)
    # Squared deviations about the common mean: sum of m2 + n mean^2, less N times the common mean squared.
    m2 = F.sum(F.col("m2")) + F.sum(F.col("n") * (F.col("mean") - F.col("middle")) ** 2)
    centre = rows.groupBy("feature").agg(mean.alias("middle"))
    joined = rows.join(F.broadcast(centre), "feature")  # one row per feature
    return joined.groupBy("feature", "kind").agg(
        n.alias("n"), F.sum("missing").alias("missing"), F.sum("zeros").alias("zeros"), F.first("middle").alias("mean"), m2.alias("m2"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("letters").alias("letters"),
        F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("ranks").alias("ranks"))


def figures(rows: DataFrame, quantiles: tuple[float, ...] = (0.5,)) -> DataFrame:
    """(feature, stat, num_value) of merged sketch rows, named as the exact profile names them."""
    def rounded(x):
        return F.round(x, STAT_DECIMALS)

    names = {0.5: "median"}
    stats = {"count": F.col("n"), "missing": F.col("missing"), "unique": F.hll_sketch_estimate("distinct")}
    number = {"mean": rounded(F.col("mean")), "std_dev": rounded(F.sqrt(F.try_divide(F.col("m2"), F.col("n")))),
              "num_zeros": F.col("zeros"), "min": F.col("low"), "max": F.col("high")}
    for q in quantiles:
        number[names.get(q, f"q{q:g}")] = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("ranks", F.lit(q)))
    text = {"avg_length": rounded(F.try_divide(F.col("letters"), F.col("n")))}

    def listed(items):
        return F.array(*[F.struct(F.lit(k).alias("stat"), e.cast("double").alias("num_value")) for k, e in items.items()])

    both = F.when(F.col("kind") == "num", listed({**stats, **number})).otherwise(listed({**stats, **text}))
    return rows.select("feature", F.inline(both))


def running_profile(spark: SparkSession, root: str, quantiles: tuple[float, ...] = (0.5,)) -> DataFrame:
    """The profile of all batches stored under ``root``."""
    return figures(merge(stored(spark, root)), quantiles)


def distinct_counts(df: DataFrame, features: list[str]) -> DataFrame:
    """(feature, truth): exact distinct values of every feature, by one scan and one aggregate each."""
    out = None
    for x in features:
        values = df.select(c(x).alias("value")).where(F.col("value").isNotNull()).distinct()
        one = values.agg(F.count(F.lit(1)).alias("truth")).select(F.lit(x).alias("feature"), "truth")
        out = one if out is None else out.unionByName(one)
    return out
