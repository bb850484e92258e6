"""E1 -> E2 end to end on the smallest tables: train and save, then score a new batch with the
saved state and the newest model."""

from pyspark.sql import functions as F

from ledgerline import extend_dictionary, save_state, score_job, train_job
from ledgerline.operators.encode import add_index, encode_transactions
from ledgerline.plans.catalog import FEATURES
from ledgerline.plans.pipeline import ENRICHED_COLUMNS, enrich_batch
from ledgerline.session import scratch_path
from ledgerline.sources.fixtures import batches


def test_train_then_score_job(spark, raw):
    t, n = raw
    train, score, cut, n = batches(t, n)
    enriched, st = enrich_batch(train, index_offset=0, n_rows=cut)
    enriched = enriched.select(*ENRICHED_COLUMNS)
    state_dir, registry = scratch_path(spark, "state"), scratch_path(spark, "registry")
    save_state(spark, st, state_dir)
    _, pred, report, path = train_job(enriched, enriched, FEATURES, registry=registry, num_trees=5, max_depth=4)
    assert path is not None and report.count() >= 4
    scored = score_job(spark, score, state_dir, registry, batch_id=1)
    assert scored.count() == n - cut
    assert scored.where(F.col("Is_Laundering_Prediction").isNull()).count() == 0
    assert scored.where(F.col("from_degree").isNull() | F.col("to_degree").isNull()).count() == 0


def test_extend_dictionary_appends_after_max(spark, raw):
    t, n = raw
    train, score, cut, n = batches(t, n)
    _, s1 = encode_transactions(train, index_offset=0, n_rows=cut)
    indexed, _ = add_index(score, "row_id", cut, n - cut)
    ext = extend_dictionary(s1.dims["account"], indexed, "account")
    old_max = s1.dims["account"].agg(F.max("code")).first()[0]
    new = ext.join(s1.dims["account"], "value", "left_anti")
    codes = sorted(r["code"] for r in new.collect())
    assert codes == list(range(old_max + 1, old_max + 1 + len(codes)))
