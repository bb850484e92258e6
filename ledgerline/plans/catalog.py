"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver tables (through the ``transactions`` fixture) and runs over
whole tables. Output column names match the oracle SQL in ``checks/oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import c, date_parts, epoch_seconds, midnight_epoch, parse_double, parse_long, parse_ts
from ..operators import encode as enc
from ..operators import graph as g
from ..operators.enrich import edge_list_lines
from ..operators.rank import head_by_index
from ..sources import fixtures as fx
from ..session import freeze
from .pipeline import ENRICHED_COLUMNS, enrich_all, enriched_transactions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def _encoded(spark, sf_dir):
    t, n = fx.transactions_n(spark, sf_dir)
    return enc.encode_transactions(t, index_offset=0, n_rows=n)


def _two_batches(spark, sf_dir):
    """Train batch (first 20 % in time order) then score batch, encoded with carried state."""
    t, n = fx.transactions_n(spark, sf_dir)
    train, score, cut, n = fx.batches(t, n)
    e1, s1 = enc.encode_transactions(train, index_offset=0, n_rows=cut)
    e2, s2 = enc.encode_transactions(score, s1, index_offset=cut, n_rows=n - cut)
    return e1, s1, e2, s2


@register("row_index")
def q_row_index(spark, sf_dir):
    return fx.transactions(spark, sf_dir)


@register("head_positive")
def q_head_positive(spark, sf_dir):
    """O3 + F6: the first 40,000 transfers (head-n is the feature), then the label filter."""
    t = fx.transactions(spark, sf_dir)
    return head_by_index(t, 40000).where(c("Is Laundering") == "1")


@register("encode_first_seen")
def q_encode(spark, sf_dir):
    e, _ = _encoded(spark, sf_dir)
    return e


@register("anchor_elapsed")
def q_anchor(spark, sf_dir):
    t = fx.transactions(spark, sf_dir).withColumn("Index", F.col("row_id"))
    anchor = enc.fit_anchor(t)
    ts = parse_ts("Timestamp")
    day, month, year = date_parts(ts)
    return t.select(
        "row_id", day.alias("day"), month.alias("month"), year.alias("year"),
        epoch_seconds(ts).alias("epoch_s"), midnight_epoch(ts).alias("midnight_s"),
        (epoch_seconds(ts) - F.lit(anchor)).alias("elapsed_s"))


@register("dict_extend")
def q_dict_extend(spark, sf_dir):
    _, _, _, s2 = _two_batches(spark, sf_dir)
    return s2.dims["account"]


@register("edges_last_wins")
def q_edges(spark, sf_dir):
    e, _ = _encoded(spark, sf_dir)
    return g.build_edges(e)


@register("graph_counts")
def q_graph_counts(spark, sf_dir):
    e, _ = _encoded(spark, sf_dir)
    return g.graph_counts(g.build_edges(e))


def _features(spark, sf_dir):
    e, _ = _encoded(spark, sf_dir)
    return g.node_features(g.build_edges(e))


@register("degrees")
def q_degrees(spark, sf_dir):
    e, _ = _encoded(spark, sf_dir)
    return g.node_stats(g.build_edges(e)).select("Node", "in_degree", "out_degree", "degree")


@register("degree_centrality")
def q_centrality(spark, sf_dir):
    return _features(spark, sf_dir).select("Node", "degree_centrality")


@register("clustering")
def q_clustering(spark, sf_dir):
    e, _ = _encoded(spark, sf_dir)
    pt, stats, n = g.graph_tables(g.build_edges(e))
    return g.clustering(None, stats, pt, n)


@register("node_features")
def q_node_features(spark, sf_dir):
    return _features(spark, sf_dir)


@register("enrich")
def q_enrich(spark, sf_dir):
    return enriched_transactions(spark, sf_dir)


@register("enrich_broadcast")
def q_enrich_broadcast(spark, sf_dir):
    return enriched_transactions(spark, sf_dir, broadcast=True)


@register("edge_list_sorted")
def q_edge_list(spark, sf_dir):
    e, _ = _encoded(spark, sf_dir)
    return edge_list_lines(e, sort=True)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


__all__ = ["QUERIES", "queries", "ENRICHED_COLUMNS"]


# --- exploration and data quality (A1-A8, F1-F5, Q7) -------------------------------------

from ..operators import eda  # noqa: E402

AMOUNTS = ["Amount Paid", "Amount Received"]
CATEGORICAL = ["Payment Format", "Payment Currency", "Receiving Currency"]
STAT_DECIMALS = 6


def _round(df, cols):
    return df.select(*[F.round(F.col(x), STAT_DECIMALS).alias(x) if x in cols else F.col(f"`{x}`") for x in df.columns])


@register("cardinality")
def q_cardinality(spark, sf_dir):
    return eda.cardinality(fx.transactions(spark, sf_dir), ["From Bank", "Account", "To Bank", "Account.1"])


@register("value_counts_by_label")
def q_value_counts(spark, sf_dir):
    return eda.value_counts(fx.transactions(spark, sf_dir), CATEGORICAL, by=["Is Laundering"])


@register("positive_slice")
def q_positive_slice(spark, sf_dir):
    return eda.slice_by_label(fx.transactions(spark, sf_dir))


@register("amount_summary")
def q_amount_summary(spark, sf_dir):
    return _round(eda.amount_summary(fx.transactions(spark, sf_dir), AMOUNTS), ["min", "max", "mean", "median"])


@register("group_size")
def q_group_size(spark, sf_dir):
    t = fx.transactions(spark, sf_dir)
    return t.groupBy(c("Payment Format")).agg(F.count(F.lit(1)).cast("long").alias("count"))


@register("describe_all")
def q_describe_all(spark, sf_dir):
    return eda.describe_strings(fx.transactions(spark, sf_dir).drop("row_id"))


@register("describe_numeric")
def q_describe_numeric(spark, sf_dir):
    e, _ = _encoded(spark, sf_dir)
    cols = [x for x in enc.ENCODED_COLUMNS if x != "Index"]
    return _round(eda.describe_numeric(e, cols), ["mean", "std", "min", "max", "p25", "p50", "p75"])


@register("null_counts")
def q_null_counts(spark, sf_dir):
    return eda.null_counts(fx.transactions_dirty(spark, sf_dir))


@register("table_info")
def q_table_info(spark, sf_dir):
    return eda.info(fx.transactions_dirty(spark, sf_dir))


@register("class_counts")
def q_class_counts(spark, sf_dir):
    t = fx.transactions(spark, sf_dir)
    return t.groupBy(c("Is Laundering")).agg(F.count(F.lit(1)).cast("long").alias("count"))


@register("negative_rows")
def q_negative_rows(spark, sf_dir):
    return eda.find_negative(fx.transactions_dirty(spark, sf_dir), AMOUNTS)


@register("null_rows")
def q_null_rows(spark, sf_dir):
    return eda.find_nulls(fx.transactions_dirty(spark, sf_dir))


@register("drop_missing")
def q_drop_missing(spark, sf_dir):
    return eda.clean(fx.transactions_dirty(spark, sf_dir))


@register("quality_report")
def q_quality_report(spark, sf_dir):
    return eda.quality_report(fx.transactions_dirty(spark, sf_dir), AMOUNTS)


# --- splits, scaling, evaluation (M1, M2, M4, A11-A15, F4) --------------------------------

from ..operators import metrics as mt  # noqa: E402
from ..operators.scale import apply_minmax, fit_minmax  # noqa: E402
from ..operators.split import split  # noqa: E402

FEATURES = [x for x in ENRICHED_COLUMNS if x not in ("Index", "Is_Laundering")]
METRIC_DECIMALS = 9


def rule_scored(spark, sf_dir):
    """Encoded transfers scored by a fixed rule (received below 90.5 % of paid), so metrics
    have an exact SQL oracle; the forest scorer is checked separately."""
    e, _ = _encoded(spark, sf_dir)
    return e.withColumn("Is_Laundering_Prediction",
                        (F.col("Amount_Received") * 10 < F.col("Amount_Paid") * 9.05).cast("long"))


def rule_labels(spark, sf_dir):
    """Label and prediction of the same rule, parsed from the raw transfers: metrics need no dictionaries."""
    t = fx.transactions(spark, sf_dir)
    flagged = parse_double("Amount Received") * 10 < parse_double("Amount Paid") * 9.05
    return t.select(parse_long("Is Laundering").alias("Is_Laundering"), flagged.cast("long").alias("Is_Laundering_Prediction"))


@register("split_random")
def q_split_random(spark, sf_dir):
    return split(fx.transactions(spark, sf_dir).select("row_id"), "row_id", test=0.2, seed=42)


@register("split_stratified")
def q_split_stratified(spark, sf_dir):
    t = fx.transactions(spark, sf_dir).select("row_id", c("Is Laundering"))
    return split(t, "row_id", test=0.2, seed=42, stratify="Is Laundering")


@register("minmax")
def q_minmax(spark, sf_dir):
    df = enriched_transactions(spark, sf_dir)
    return apply_minmax(df, fit_minmax(df, FEATURES)).select("Index", *FEATURES)


@register("confusion")
def q_confusion(spark, sf_dir):
    return mt.confusion(rule_labels(spark, sf_dir))


@register("classification_report")
def q_classification_report(spark, sf_dir):
    r = mt.classification_report(freeze(mt.confusion(rule_labels(spark, sf_dir)), "confusion"))
    return r.select("class", *[F.round(x, METRIC_DECIMALS).alias(x) for x in ["precision", "recall", "f1"]], "support")


@register("binary_metrics")
def q_binary_metrics(spark, sf_dir):
    r = mt.binary_metrics(freeze(mt.confusion(rule_labels(spark, sf_dir)), "confusion"))
    return r.select(*[F.round(x, METRIC_DECIMALS).alias(x) for x in r.columns])


@register("score_summary")
def q_score_summary(spark, sf_dir):
    return eda.score_summary(rule_labels(spark, sf_dir))


@register("flagged_rows")
def q_flagged(spark, sf_dir):
    return eda.flagged(rule_scored(spark, sf_dir))


# --- label encoding, graph merge, run state (M3, G3, U4, S4, S6, K1, T2) -------------------

from ..session import scratch_path  # noqa: E402
from ..sources import state as stt  # noqa: E402
from ..streaming.state_update import update_state  # noqa: E402

LABEL_ENCODED = ["Account", "Account.1", "Receiving Currency", "Payment Currency", "Payment Format"]


@register("label_encode")
def q_label_encode(spark, sf_dir):
    t = fx.transactions(spark, sf_dir).drop("Timestamp")
    return enc.label_encode(t, LABEL_ENCODED)


@register("graph_merge")
def q_graph_merge(spark, sf_dir):
    e1, _, e2, _ = _two_batches(spark, sf_dir)
    return g.merge_edges(g.build_edges(e1), g.build_edges(e2))


@register("state_roundtrip")
def q_state_roundtrip(spark, sf_dir):
    e, st = _encoded(spark, sf_dir)
    st.edges = g.build_edges(e)
    loaded = stt.save_state(spark, st, scratch_path(spark, "state"))
    return loaded.dims["account"].withColumn("anchor", F.lit(loaded.anchor).cast("long"))


@register("state_update")
def q_state_update(spark, sf_dir):
    """Two batches through the state store, the second replayed: final dictionaries."""
    t, n = fx.transactions_n(spark, sf_dir)
    train, score, cut, n = fx.batches(t, n)
    sdir = scratch_path(spark, "state")
    update_state(spark, train, sdir, 0)
    update_state(spark, score, sdir, 1)
    _, final = update_state(spark, score, sdir, 1)  # replay: no-op
    return stt.dims_table(final)


@register("state_graph")
def q_state_graph(spark, sf_dir):
    """The edges reloaded after two batches and a replay of the second."""
    t, n = fx.transactions_n(spark, sf_dir)
    train, score, cut, n = fx.batches(t, n)
    sdir = scratch_path(spark, "state")
    for batch, bid in ((train, 0), (score, 1), (score, 1)):
        update_state(spark, batch, sdir, bid)
    return stt.load_state(spark, sdir).edges


@register("score_batch_enriched")
def q_score_batch_enriched(spark, sf_dir):
    """The second batch with features of its accounts on the graph of both batches."""
    from .pipeline import enrich_batch
    t, n = fx.transactions_n(spark, sf_dir)
    train, score, cut, n = fx.batches(t, n)
    e1, s1 = enc.encode_transactions(train, index_offset=0, n_rows=cut)
    s1.edges = freeze(g.build_edges(e1), "edges")
    out, _ = enrich_batch(score, s1, index_offset=cut, n_rows=n - cut)
    return out.select(*ENRICHED_COLUMNS)


# --- sources and sinks (S1-S3, S5, S7, S8, K2-K5, T1, T3) ----------------------------------

from ..sinks import writers as wr  # noqa: E402
from ..sources import readers as rd  # noqa: E402
from ..sources.registry import latest_model  # noqa: E402
from ..streaming.score_stream import stream_score  # noqa: E402

ENCODED_TYPES = ("Index long, From_ID long, To_ID long, Timestamp double, Amount_Paid double, "
                 "Payment_Currency long, Amount_Received double, Receiving_Currency long, Payment_Format long, "
                 "Is_Laundering long, batch_id long, Is_Laundering_Prediction long")


def _rule(df):
    return df.withColumn("Is_Laundering_Prediction",
                         (F.col("Amount_Received") * 10 < F.col("Amount_Paid") * 9.05).cast("long"))


@register("read_typed")
def q_read_typed(spark, sf_dir):
    p = scratch_path(spark, "csv")
    wr.write_csv(fx.transactions(spark, sf_dir), p)
    t = rd.read_transactions(spark, p, typed=True, with_row_id=True)
    return t.withColumn("Timestamp", epoch_seconds(F.col("Timestamp")))


@register("read_inferred")
def q_read_inferred(spark, sf_dir):
    """The raw file with nothing declared but the column names: types and the time pattern found from all rows."""
    p = scratch_path(spark, "csv")
    wr.write_csv(fx.transactions(spark, sf_dir), p)
    t = rd.read_inferred(spark, p, ["row_id", *fx.RAW_COLUMNS])
    return t.withColumn("Timestamp", epoch_seconds(F.col("Timestamp"))).withColumn("row_id", F.col("row_id").cast("long"))


@register("ingest_checked")
def q_ingest_checked(spark, sf_dir):
    """The quality report collected by the write of the dirty table itself."""
    return wr.write_checked(fx.transactions_dirty(spark, sf_dir), scratch_path(spark, "ingested"), AMOUNTS)


@register("read_strings")
def q_read_strings(spark, sf_dir):
    p = scratch_path(spark, "csv")
    wr.write_csv(fx.transactions_dirty(spark, sf_dir), p)
    return rd.read_transactions(spark, p, typed=False, with_row_id=True)


@register("snapshot_roundtrip")
def q_snapshot(spark, sf_dir):
    p = scratch_path(spark, "predictions")
    wr.write_predictions(rule_scored(spark, sf_dir), p)
    return rd.read_snapshot(spark, p)


@register("json_records")
def q_json_records(spark, sf_dir):
    feats = _features(spark, sf_dir)
    text = wr.to_records(feats).select(F.translate("record", '"', "'").alias("record"))
    return rd.parse_records(text, "record", feats.schema, single_quotes=True)


@register("csv_export")
def q_csv_export(spark, sf_dir):
    p = scratch_path(spark, "flagged-csv")
    wr.write_csv(eda.flagged(rule_scored(spark, sf_dir)), p)
    return spark.read.schema(ENCODED_TYPES).option("header", True).csv(p)


@register("append_training")
def q_append_training(spark, sf_dir):
    e1, _, e2, _ = _two_batches(spark, sf_dir)
    p = scratch_path(spark, "training")
    wr.append_training(e1, p)
    wr.append_training(e2, p)
    wr.append_training(e2, p)  # replayed batch: its partition is replaced, not duplicated
    return spark.read.parquet(p).withColumn("batch_id", F.col("batch_id").cast("long"))


@register("latest_model")
def q_latest_model(spark, sf_dir):
    """One registry per customer, one saved-model folder per order (version from its date and key)."""
    o = fx.table(spark, sf_dir, "orders")
    s = F.col("o_orderkey") % 86400
    hhmmss = F.concat(F.lpad((s / 3600).cast("int").cast("string"), 2, "0"),
                      F.lpad(((s % 3600) / 60).cast("int").cast("string"), 2, "0"),
                      F.lpad((s % 60).cast("string"), 2, "0"))
    listing = o.select(F.col("o_custkey").alias("registry"), F.concat(
        F.lit("/registry/"), F.col("o_custkey").cast("string"), F.lit("/model_"),
        F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_"), hhmmss).alias("path"))
    return latest_model(listing, "path", by=["registry"])


@register("stream_score")
def q_stream_score(spark, sf_dir):
    """Two folders of 11-column files scored in file order by the stream, state and ledger carried between them."""
    t, n = fx.transactions_n(spark, sf_dir)
    root = scratch_path(spark, "landing")
    k = 2
    for i in range(k):
        part = t.where((F.col("row_id") >= i * n // k) & (F.col("row_id") < (i + 1) * n // k))
        # Sorted part files: their names follow the row order.
        wr.write_csv(part.orderBy("row_id").drop("row_id"), f"{root}/arrival-{i}")
    state_dir, out_dir, flag_dir = (scratch_path(spark, x) for x in ("stream-state", "scored", "flagged"))
    for i in range(k):
        stream_score(spark, f"{root}/arrival-{i}", state_dir, out_dir, _rule, flagged_dir=flag_dir, keep=["row_id"])
    cols = ["row_id"] + [x for x in enc.ENCODED_COLUMNS if x != "Index"] + ["Is_Laundering_Prediction"]
    return spark.read.parquet(out_dir).select(*cols)


@register("graph_increment")
def q_graph_increment(spark, sf_dir):
    """Five batches taken into the incremental graph state one after the other: features of all accounts at the end."""
    from ..sources.graph_state import GraphState
    t, n = fx.transactions_n(spark, sf_dir)
    graph, st, k = GraphState.load(spark, scratch_path(spark, "graph"), -1), None, 5
    for b in range(k):
        lo, hi = b * n // k, (b + 1) * n // k
        part = t.where((F.col("row_id") >= lo) & (F.col("row_id") < hi))
        e, st = enc.encode_transactions(part, st, index_offset=lo, n_rows=hi - lo)
        graph = graph.apply(g.build_edges(e), b)
    return graph.features()


# --- data validation (Q1-Q6, K7) ------------------------------------------------------------

from ..operators import quality as qa  # noqa: E402
from ..operators import running  # noqa: E402


def typed_view(raw):
    """Typed transfers for profiling: numbers as numbers, the timestamp as epoch seconds."""
    t = rd.cast_typed(raw)
    return t.withColumn("Timestamp", epoch_seconds(F.col("Timestamp"))).drop("row_id")


def _train_new(spark, sf_dir, dirty_new=False):
    t, n = fx.transactions_n(spark, sf_dir)
    train, score, cut, n = fx.batches(t, n)
    if dirty_new:
        score = fx.dirty(t).where(F.col("row_id") >= cut)
    return typed_view(train), typed_view(score)


@register("profile_stats")
def q_profile_stats(spark, sf_dir):
    stats = qa.profile(typed_view(fx.transactions(spark, sf_dir)))
    return spark.read.parquet(wr.write_profile(stats, scratch_path(spark, "profiles"), "train"))


@register("profile_running")
def q_profile_running(spark, sf_dir):
    """Ten batches (one stored twice) merged into one profile without reading them again.

    Exact figures as they are; the sketched ones (``unique``, ``median``) as 1 if they lie within their bounds
    of the exact profile: 5 % of the distinct count, 2 % of the ranks.
    """
    t, n = fx.transactions_n(spark, sf_dir)
    root = scratch_path(spark, "sketches")
    for b in [*range(10), 3]:
        part = t.where((F.col("row_id") >= b * n // 10) & (F.col("row_id") < (b + 1) * n // 10))
        running.add_batch(typed_view(part), root, b)
    got = freeze(running.running_profile(spark, root), "running")
    whole = typed_view(t)
    num, txt = qa.split_features(whole)
    # Feature by feature: a task holds the distinct values of one feature, not of all.
    exact = running.distinct_counts(whole, num + txt)
    middle = {r["feature"]: r["num_value"] for r in got.where("stat = 'median'").collect()}
    ranks = whole.agg(*[F.struct(F.avg((c(x) < middle[x]).cast("double")).alias("lo"), F.avg((c(x) <= middle[x]).cast("double")).alias("hi")).alias(x)
                        for x in num]).select(F.inline(F.array(*[F.struct(F.lit(x).alias("feature"), c(x).alias("at")) for x in num])))
    unique = F.abs(F.col("num_value") - F.col("truth")) <= F.greatest(F.lit(1.0), 0.05 * F.col("truth"))
    median = (F.col("at.lo") <= 0.52) & (F.col("at.hi") >= 0.48)
    out = got.join(exact, "feature").join(ranks, "feature", "left")
    value = F.when(F.col("stat") == "unique", unique.cast("double")).when(F.col("stat") == "median", median.cast("double"))
    return out.select("feature", "stat", F.coalesce(value, F.col("num_value")).alias("num_value"))


@register("profile_top_values")
def q_profile_top_values(spark, sf_dir):
    return qa.top_values(typed_view(fx.transactions(spark, sf_dir)), 10)


@register("profile_quantiles")
def q_profile_quantiles(spark, sf_dir):
    return _round(qa.quantile_bins(typed_view(fx.transactions(spark, sf_dir)), 10), ["value"])


@register("profile_slice")
def q_profile_slice(spark, sf_dir):
    t = typed_view(fx.transactions(spark, sf_dir)).select(c("Payment Currency"), c("Receiving Currency"))
    return qa.profile(t)


@register("histograms")
def q_histograms(spark, sf_dir):
    t = typed_view(fx.transactions(spark, sf_dir))
    num, _ = qa.split_features(t)
    return qa.histogram(t, num)


@register("schema_inferred")
def q_schema_inferred(spark, sf_dir):
    t = typed_view(fx.transactions(spark, sf_dir))
    return qa.infer_expectations(qa.profile(t), t)


@register("anomalies")
def q_anomalies(spark, sf_dir):
    train, new = _train_new(spark, sf_dir, dirty_new=True)
    exp = qa.infer_expectations(qa.profile(train), train)
    return qa.validate(new, exp, qa.domains(train, exp))


@register("compare_profiles")
def q_compare_profiles(spark, sf_dir):
    train, new = _train_new(spark, sf_dir)
    return qa.compare_profiles(qa.profile(train), qa.profile(new))


@register("drift")
def q_drift(spark, sf_dir):
    train, new = _train_new(spark, sf_dir)
    return qa.drift(train, new)


# --- model (M5, M7-M10, K6, S7) -------------------------------------------------------------

from ..operators.resample import oversample_latent  # noqa: E402
from ..operators.smote import knn, smote  # noqa: E402
from ..sources.registry import list_models  # noqa: E402
from .jobs import load_latest, predictions_path, report_from_predictions, report_path, retrain_job, train_job  # noqa: E402

REPORT_FIGURES = ["precision", "recall", "f1", "support"]


_REGISTRIES: dict[tuple[str, str], str] = {}


def _trained(spark, sf_dir) -> tuple[str, DataFrame]:
    """(registry with a model grown on 80 % of the transfers, the other 20 %); grown once per application and input."""
    t, n = fx.transactions_n(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _REGISTRIES or not stt.exists(spark, _REGISTRIES[key]):
        df = split(freeze(enrich_all(t, n), "enriched"), "Index", test=0.2, seed=42)
        train, test = (df.where(F.col("is_test") == i).drop("is_test") for i in (0, 1))
        registry = scratch_path(spark, "registry")
        test.write.parquet(f"{registry}/test-rows")
        train_job(train, test, FEATURES, registry=registry)
        _REGISTRIES[key] = registry
    return _REGISTRIES[key], spark.read.parquet(f"{_REGISTRIES[key]}/test-rows")


@register("forest_score")
def q_forest_score(spark, sf_dir):
    """Train on 80 % of the transfers, save, reload the newest model, score the other 20 %.

    SQL cannot grow the forest; the oracle checks which rows are scored and that each has a class.
    """
    registry, test = _trained(spark, sf_dir)
    scored = load_latest(spark, registry).score(test)
    return scored.select("Index", "Is_Laundering", F.col("Is_Laundering_Prediction").isin(0, 1).alias("has_class"))


@register("retrain")
def q_retrain(spark, sf_dir):
    """A scored second batch joins the training table and the model is grown again: rows per batch, models kept."""
    from .pipeline import enrich_batch
    t, n = fx.transactions_n(spark, sf_dir)
    train, score, cut, n = fx.batches(t, n)
    first, st = enrich_batch(train, index_offset=0, n_rows=cut, batch_id=0)
    first = freeze(first, "first")
    registry, table_dir = scratch_path(spark, "registry"), scratch_path(spark, "training")
    wr.append_training(first, table_dir)
    # Held-out rows of the first batch for its report; the second model is tested on the second batch's.
    held = split(first, "Index", test=0.2, seed=42)
    scorer = train_job(*(held.where(F.col("is_test") == i).drop("is_test") for i in (0, 1)), FEATURES, registry=registry)[0]
    st.edges = freeze(st.edges, "edges")
    second = freeze(enrich_batch(score, st, index_offset=cut, n_rows=n - cut, batch_id=1)[0], "second")
    scored = freeze(scorer.score(second), "scored")
    retrain_job(table_dir, scored, second, FEATURES, registry)
    rows = spark.read.parquet(table_dir).groupBy(F.col("batch_id").cast("long").alias("batch_id")).agg(
        F.count(F.lit(1)).alias("n_rows"))
    return rows.withColumn("n_models", F.lit(list_models(spark, registry).count()).cast("long"))


@register("stream_model")
def q_stream_model(spark, sf_dir):
    """Two landing folders and a late file in the first, scored as they come by the newest saved model.

    SQL cannot vote with the trees: ``as_saved`` says whether the stored rows, scored once more by the
    saved model, get the prediction that the stream wrote.
    """
    t, n = fx.transactions_n(spark, sf_dir)
    registry, _ = _trained(spark, sf_dir)
    root, state_dir, out_dir = (scratch_path(spark, x) for x in ("landing", "stream-state", "scored"))
    for i, folder in enumerate(["a", "b", "a"]):
        part = t.where((F.col("row_id") >= i * n // 3) & (F.col("row_id") < (i + 1) * n // 3))
        wr.write_csv(part.orderBy("row_id").drop("row_id"), f"{root}/{folder}", mode="append")
        stream_score(spark, f"{root}/{folder}", state_dir, out_dir, registry=registry, keep=["row_id"])
    rows = spark.read.parquet(out_dir)
    again = load_latest(spark, registry).score(rows.withColumnRenamed("Is_Laundering_Prediction", "streamed"))
    return again.select("row_id", "Is_Laundering", (F.col("streamed") == F.col("Is_Laundering_Prediction")).alias("as_saved"))


@register("model_report")
def q_model_report(spark, sf_dir):
    """The report stored beside the newest model against the same figures recomputed in SQL from its stored predictions.

    Supports have an oracle; ``stored`` says whether every figure is what the predictions give.
    """
    registry, _ = _trained(spark, sf_dir)
    path = latest_model(list_models(spark, registry)).first()["latest_path"]
    again = report_from_predictions(spark.read.parquet(predictions_path(path)))
    kept = spark.read.parquet(report_path(path)).select("class", *[F.col(x).alias(f"kept_{x}") for x in REPORT_FIGURES])
    same = [F.coalesce(F.abs(F.col(x) - F.col(f"kept_{x}")) < 1e-12, F.col(x).isNull() & F.col(f"kept_{x}").isNull()) for x in REPORT_FIGURES]
    return again.join(kept, "class", "left").select("class", "support", F.forall(F.array(*same), lambda x: x).alias("stored"))


@register("latent_oversample")
def q_latent_oversample(spark, sf_dir):
    """One synthetic row per positive transfer; the oracle checks the rows and that features lie in [0, 1]."""
    df = freeze(enriched_transactions(spark, sf_dir), "enriched")
    scaled = apply_minmax(df, fit_minmax(df, FEATURES))
    out = oversample_latent(scaled, FEATURES, key="Index")
    inside = F.forall(F.array(*[c(x) for x in FEATURES]), lambda v: (v >= 0) & (v <= 1))
    return out.select("Index", "Is_Laundering", "is_synthetic", inside.alias("in_range"))


def _scaled_enriched(spark, sf_dir):
    """Scaled as they are read: only the minority's rows are written once more, by what searches them."""
    df = freeze(enriched_transactions(spark, sf_dir), "enriched")
    return apply_minmax(df, fit_minmax(df, FEATURES))


@register("smote_knn")
def q_smote_knn(spark, sf_dir):
    """Distances to the five nearest minority rows, for every minority row."""
    near = knn(_scaled_enriched(spark, sf_dir).where("Is_Laundering = 1"), "Index", FEATURES, k=5)
    return near.select(F.col("key").alias("Index"), "nn_rank", F.round("dist", STAT_DECIMALS).alias("dist"))


@register("smote_rows")
def q_smote_rows(spark, sf_dir):
    """SMOTE until both classes are equal: synthetic rows per class, and how many lie outside [0, 1]."""
    rows = smote(_scaled_enriched(spark, sf_dir), FEATURES, key="Index")
    outside = F.exists(F.array(*[c(x) for x in FEATURES]), lambda v: (v < 0) | (v > 1))
    return rows.groupBy("Is_Laundering").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(outside).alias("n_outside"))
