"""Data validation (Q1-Q6): statistics, inferred expectations, anomalies, comparison, drift.

Statistics are tidy tables ``(feature, stat, num_value, str_value)`` computed in a few
whole-table aggregations over unpivoted (feature, value) rows; exact medians use the
distributed row index. Expectations are derived from the statistics alone; validation
checks a new table against them with one aggregate plus an anti-join for unseen values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from ..session import freeze
from .eda import _melt, exact_quantiles, value_counts

# A text feature with at most this many distinct values gets a value domain (default of ``max_domain``).
MAX_DOMAIN = 100
HIST_BUCKETS = 10
STAT_DECIMALS = 6


def split_features(df: DataFrame, exclude: list[str] | None = None) -> tuple[list[str], list[str]]:
    exclude = set(exclude or [])
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in exclude]
    txt = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType) and f.name not in exclude]
    return num, txt


def _tidy(df: DataFrame, stats: list[str], kind: str) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(s).alias("stat"),
                             (F.col(s).cast("double") if kind == "num" else F.lit(None).cast("double")).alias("num_value"),
                             (F.col(s).cast("string") if kind == "str" else F.lit(None).cast("string")).alias("str_value"))
                    for s in stats])
    return df.select("feature", F.inline(arr))


def profile(df: DataFrame, exclude: list[str] | None = None) -> DataFrame:
    """Q1/Q6: per-feature statistics as (feature, stat, num_value, str_value)."""
    num, txt = split_features(df, exclude)
    parts = []
    if num:
        m = _melt(df, num, cast="double").withColumnRenamed("column", "feature")
        basic = m.groupBy("feature").agg(
            F.count("value").alias("count"), F.count_if(F.col("value").isNull()).alias("missing"),
            F.round(F.avg("value"), STAT_DECIMALS).alias("mean"),
            F.round(F.stddev_pop("value"), STAT_DECIMALS).alias("std_dev"),
            F.count_if(F.col("value") == 0).alias("num_zeros"),
            F.min("value").alias("min"), F.max("value").alias("max"))
        med = exact_quantiles(m, ["feature"], "value", [0.5]).select(
            "feature", F.round("value", STAT_DECIMALS).alias("median"))
        basic = basic.join(med, "feature", "left")
        parts.append(_tidy(basic, ["count", "missing", "mean", "std_dev", "num_zeros", "min", "median", "max"], "num"))
    if txt:
        m = _melt(df, txt).withColumnRenamed("column", "feature")
        vc = m.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
        per = vc.groupBy("feature").agg(
            F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("count"),
            F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("missing"),
            F.count("value").alias("unique"),
            F.max(F.when(F.col("value").isNotNull(), F.col("n"))).alias("top_freq"),
            F.min_by(F.col("value"), F.struct(F.col("value").isNull(), -F.col("n"), F.col("value"))).alias("top_value"),
            F.round(F.sum(F.length("value") * F.col("n")) / F.sum(F.when(F.col("value").isNotNull(), F.col("n"))),
                    STAT_DECIMALS).alias("avg_length"))
        parts.append(_tidy(per, ["count", "missing", "unique", "top_freq", "avg_length"], "num")
                     .unionByName(_tidy(per, ["top_value"], "str")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def top_values(df: DataFrame, n: int = 10, exclude: list[str] | None = None) -> DataFrame:
    """Q1: the ``n`` most frequent values of every text feature: (feature, rank, value, count), ties by value.

    Values are counted once and written; each feature's first rows are then taken by a top-n of
    ``n`` rows per task.
    """
    _, txt = split_features(df, exclude)
    counts = freeze(value_counts(df, txt).withColumnRenamed("column", "feature"), "feature-values")
    out = None
    for x in txt:
        top = counts.where(F.col("feature") == x).orderBy(F.desc("count"), "value").limit(n)
        out = top if out is None else out.unionByName(top)
    w = Window.partitionBy("feature").orderBy(F.desc("count"), "value")  # n rows per feature
    return out.select("feature", F.row_number().over(w).alias("rank"), "value", "count")


def quantile_bins(df: DataFrame, bins: int = 10, exclude: list[str] | None = None) -> DataFrame:
    """Q1: edges of ``bins`` equally filled bins of every numeric feature: (feature, q, value)."""
    num, _ = split_features(df, exclude)
    m = _melt(df, num, cast="double").withColumnRenamed("column", "feature")
    return exact_quantiles(m, ["feature"], "value", [i / bins for i in range(bins + 1)])


def histogram(df: DataFrame, columns: list[str], buckets: int = HIST_BUCKETS,
              ranges: DataFrame | None = None) -> DataFrame:
    """Equal-width histogram per numeric feature: (feature, bucket, count).

    ``ranges`` (feature, lo, hi) fixes shared bin edges, e.g. for comparing two tables.
    """
    m = _melt(df, columns, cast="double").withColumnRenamed("column", "feature").where(F.col("value").isNotNull())
    if ranges is None:
        ranges = m.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    j = m.join(F.broadcast(ranges), "feature")  # one row per feature
    b = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * buckets), F.lit(buckets - 1)))
    return j.groupBy("feature", b.cast("int").alias("bucket")).agg(F.count(F.lit(1)).cast("long").alias("count"))


def infer_expectations(stats: DataFrame, df: DataFrame, exclude: list[str] | None = None,
                       max_domain: int = MAX_DOMAIN) -> DataFrame:
    """Q2: (feature, type, required, min, max, n_values, domain_size) from the statistics.

    A text feature with more than ``max_domain`` distinct values has no domain: ``domain_size`` is
    NULL, ``n_values`` says how many there are, and :func:`validate` reports it as ``no_domain``.
    """
    num, txt = split_features(df, exclude)
    types = {f.name: ("FLOAT" if f.dataType.typeName() in ("double", "float") else
                      "INT" if isinstance(f.dataType, NumericType) else "BYTES") for f in df.schema.fields}
    w = stats.groupBy("feature").agg(*[F.max(F.when(F.col("stat") == s, F.col("num_value"))).alias(s)
                                       for s in ["missing", "min", "max", "unique"]])
    type_map = F.create_map(*[x for f in num + txt for x in (F.lit(f), F.lit(types[f]))])
    return w.select(
        "feature", type_map[F.col("feature")].alias("type"), (F.col("missing") == 0).alias("required"),
        "min", "max",
        F.col("unique").cast("long").alias("n_values"),
        F.when(F.col("unique") <= max_domain, F.col("unique").cast("long")).alias("domain_size"))


def domains(df: DataFrame, expectations: DataFrame, exclude: list[str] | None = None) -> DataFrame:
    """(feature, value) allowed for text features that got a domain."""
    _, txt = split_features(df, exclude)
    m = _melt(df, txt).withColumnRenamed("column", "feature").where(F.col("value").isNotNull()).distinct()
    return m.join(expectations.where(F.col("domain_size").isNotNull()).select("feature"), "feature", "left_semi")


def validate(new: DataFrame, expectations: DataFrame, allowed: DataFrame, exclude: list[str] | None = None) -> DataFrame:
    """Q3: anomalies of ``new`` as (feature, anomaly, value, count)."""
    num, txt = split_features(new, exclude)
    feats = num + txt
    missing = _melt(new, feats).withColumnRenamed("column", "feature").groupBy("feature").agg(
        F.count_if(F.col("value").isNull()).cast("long").alias("count"))
    missing = missing.join(expectations.where("required").select("feature"), "feature", "left_semi") \
        .where(F.col("count") > 0).select("feature", F.lit("missing_values").alias("anomaly"),
                                          F.lit(None).cast("string").alias("value"), "count")
    out = missing
    if num:
        mn = _melt(new, num, cast="double").withColumnRenamed("column", "feature").where(F.col("value").isNotNull())
        rng = mn.join(F.broadcast(expectations.select("feature", F.col("min").alias("lo"), F.col("max").alias("hi"))),
                      "feature")  # one row per feature
        oor = rng.groupBy("feature").agg(
            F.count_if(F.col("value") < F.col("lo")).cast("long").alias("below"),
            F.count_if(F.col("value") > F.col("hi")).cast("long").alias("above"))
        oor = oor.select("feature", F.inline(F.array(
            F.struct(F.lit("below_min").alias("anomaly"), F.lit(None).cast("string").alias("value"), F.col("below").alias("count")),
            F.struct(F.lit("above_max").alias("anomaly"), F.lit(None).cast("string").alias("value"), F.col("above").alias("count"))))
        ).where(F.col("count") > 0)
        out = out.unionByName(oor)
    if txt:
        # Counts first: a value that fills a column is one row before it meets the domain.
        mt = _melt(new, txt).withColumnRenamed("column", "feature").where(F.col("value").isNotNull())
        mt = mt.groupBy("feature", "value").agg(F.count(F.lit(1)).cast("long").alias("count"))
        known = expectations.where(F.col("domain_size").isNotNull()).select("feature")
        unseen = mt.join(F.broadcast(known), "feature", "left_semi").join(  # one row per feature
            allowed, ["feature", "value"], "left_anti")
        out = out.unionByName(unseen.select("feature", F.lit("unexpected_value").alias("anomaly"), "value", "count"))
        wide = expectations.where(F.col("domain_size").isNull() & F.col("n_values").isNotNull())
        out = out.unionByName(wide.select("feature", F.lit("no_domain").alias("anomaly"),
                                          F.lit(None).cast("string").alias("value"), F.col("n_values").alias("count")))
    return out


def compare_profiles(lhs: DataFrame, rhs: DataFrame) -> DataFrame:
    """Q4: two statistics tables side by side on (feature, stat)."""
    a = lhs.select("feature", "stat", F.col("num_value").alias("lhs_num"), F.col("str_value").alias("lhs_str"))
    b = rhs.select("feature", "stat", F.col("num_value").alias("rhs_num"), F.col("str_value").alias("rhs_str"))
    return a.join(b, ["feature", "stat"], "full_outer")


def drift(train: DataFrame, new: DataFrame, exclude: list[str] | None = None, buckets: int = HIST_BUCKETS) -> DataFrame:
    """Q5: L-infinity distance of category shares (text features) and Jensen-Shannon
    divergence (base 2) of shared-bin histograms (numeric features): (feature, metric, value)."""
    num, txt = split_features(train, exclude)
    parts = []
    if txt:
        def shares(df, side):
            m = _melt(df, txt).withColumnRenamed("column", "feature").where(F.col("value").isNotNull())
            vc = m.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
            tot = vc.groupBy("feature").agg(F.sum("n").alias("t"))
            return vc.join(tot, "feature").select("feature", "value", (F.col("n") / F.col("t")).alias(side))
        s = shares(train, "p").join(shares(new, "q"), ["feature", "value"], "full_outer").fillna(0.0, ["p", "q"])
        parts.append(s.groupBy("feature").agg(F.max(F.abs(F.col("p") - F.col("q"))).alias("value"))
                     .select("feature", F.lit("linf").alias("metric"), "value"))
    if num:
        def mlt(df):
            return _melt(df, num, cast="double").withColumnRenamed("column", "feature").where(F.col("value").isNotNull())
        both = mlt(train).unionByName(mlt(new))
        ranges = both.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
        ha = histogram(train, num, buckets, ranges).withColumnRenamed("count", "na")
        hb = histogram(new, num, buckets, ranges).withColumnRenamed("count", "nb")
        h = ha.join(hb, ["feature", "bucket"], "full_outer").fillna(0, ["na", "nb"])
        ta = h.groupBy("feature").agg(F.sum("na").alias("ta"), F.sum("nb").alias("tb"))
        h = h.join(ta, "feature").select("feature", (F.col("na") / F.col("ta")).alias("p"),
                                         (F.col("nb") / F.col("tb")).alias("q"))
        mid = (F.col("p") + F.col("q")) / 2
        term = (F.when(F.col("p") > 0, F.col("p") * F.log2(F.col("p") / mid)).otherwise(0.0)
                + F.when(F.col("q") > 0, F.col("q") * F.log2(F.col("q") / mid)).otherwise(0.0)) / 2
        parts.append(h.groupBy("feature").agg(F.sum(term).alias("value"))
                     .select("feature", F.lit("js_divergence").alias("metric"), "value"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("feature", "metric", F.round("value", 9).alias("value"))


