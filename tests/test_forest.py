"""The grouped forest: groups add up to one forest, finished groups are not grown again, results at the registered size."""

import duckdb
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerline.operators import model
from ledgerline.plans.jobs import predictions_path, report_from_predictions, report_path, train_job
from ledgerline.session import scratch_path
from ledgerline.sources.registry import latest_model, list_models

SF = "/root/testdata/sf0.001"
FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    u = lambda s: F.pmod(F.xxhash64("id", F.lit(s)), F.lit(1000)) / 1000.0
    df = spark.range(600).select(F.col("id").alias("Index"), u(1).alias("a"), u(2).alias("b"), F.lit(4.0).alias("c"))
    return df.withColumn("Is_Laundering", ((F.col("a") + F.col("b") > 1.2) | (F.col("a") < 0.1)).cast("long")).cache()


def test_groups_add_up_and_are_not_grown_again(spark, rows, monkeypatch):
    folder = scratch_path(spark, "forest")
    kw = {"num_trees": 7, "group_trees": 3, "max_depth": 6, "folder": folder}
    scorer = model.fit_scorer(rows, FEATURES, **kw)
    assert [g.getNumTrees for g in scorer.groups] == [3, 3, 1] and scorer.num_trees() == 7
    votes = {r["Index"]: r["_ll_votes"] for r in scorer.votes(rows).collect()}
    by_hand = {i: [0.0, 0.0] for i in votes}
    frame = model._assembled(model._with_scaled(rows, FEATURES, scorer.ranges), 3)
    for g in scorer.groups:
        g.setRawPredictionCol("raw")
        for r in g.transform(frame).select("Index", vector_to_array("raw").alias("v")).collect():
            by_hand[r["Index"]] = [x + y for x, y in zip(by_hand[r["Index"]], r["v"])]
    for i, v in votes.items():
        assert v == pytest.approx(by_hand[i]) and sum(v) == pytest.approx(7)
    scored = scorer.score(rows)
    assert scored.columns == [*rows.columns, model.PREDICTION]
    assert scored.where(F.col(model.PREDICTION) == F.col("Is_Laundering")).count() > 550

    class Grown(Exception):
        pass

    def fit(self, df):
        raise Grown

    monkeypatch.setattr(model.RandomForestClassifier, "fit", fit)
    again = model.fit_scorer(rows, FEATURES, **kw)  # every group is there
    assert {r["Index"]: r["_ll_votes"] for r in again.votes(rows).collect()} == votes
    with pytest.raises(Grown):  # a lost last group is grown anew, the others are not
        model.fit_scorer(rows, FEATURES, **{**kw, "num_trees": 10})


def test_seeds_give_different_groups_and_equal_runs(spark, rows):
    def shape():
        return [g.toDebugString.split("\n", 1)[1] for g in model.fit_scorer(rows, FEATURES, num_trees=2, group_trees=1, max_depth=4).groups]

    one = shape()
    assert one == shape() and one[0] != one[1]


def test_report_predictions_and_newest_model(spark, rows):
    registry = scratch_path(spark, "registry")
    train, test = rows.where("Index % 4 > 0"), rows.where("Index % 4 = 0")
    scorer, pred, report, path = train_job(train, test, FEATURES, registry, num_trees=4, group_trees=2, max_depth=5)
    stored = spark.read.parquet(predictions_path(path))
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, pred.select(*stored.columns).collect()))
    kept = {r["class"]: r for r in spark.read.parquet(report_path(path)).collect()}
    for r in report_from_predictions(stored).collect():
        for x in ("precision", "recall", "f1", "support"):
            assert kept[r["class"]][x] == (pytest.approx(r[x]) if r[x] is not None else None)
    # A folder without its last file is no model.
    spark.range(1).write.parquet(f"{registry}/model_99990101_000000/group-0")
    newest = latest_model(list_models(spark, registry)).first()["latest_path"]
    assert newest.endswith(path.rsplit("/", 1)[1])
    again = model.ForestScorer.load(spark, newest).score(test)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, pred.collect()))


@pytest.mark.parametrize("name", ["forest_score", "model_report"])
def test_registered_forest(spark, name):
    """100 trees to depth 30, grown once, against the oracles."""
    con = duckdb.connect()
    for t in ("lineitem", "orders", "customer", "supplier"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    want = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in want.description]
    assert sorted(map(str, want.fetchall())) == sorted(str(tuple(r)) for r in df.select(*cols).collect())
