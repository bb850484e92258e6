"""Steps that scale: the transfers' partitions, distinct counts per feature, rows of the forest."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import model, running
from ledgerline.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def partitions(spark, df):
    return spark.read.parquet(os.path.dirname(df.inputFiles()[0])).select("_ll_pid").distinct().count()


def test_transfers_partitions_grow_with_rows(spark, monkeypatch):
    """joined by shuffle or broadcast, the same rows; a task's rows are bounded."""
    monkeypatch.setattr(fx, "_MEMO", {})
    plain, n = fx.transactions_n(spark, SF)
    monkeypatch.setattr(fx, "_MEMO", {})
    monkeypatch.setattr(fx, "TASK_ROWS", 200)
    monkeypatch.setattr(fx, "BROADCAST_ORDERS", 0)
    spread, m = fx.transactions_n(spark, SF)
    assert n == m and partitions(spark, spread) > 20 >= partitions(spark, plain)
    assert plain.exceptAll(spread).isEmpty() and spread.exceptAll(plain).isEmpty()


def test_distinct_counts_hold_one_feature_at_a_time(spark):
    """no row is multiplied by the features."""
    df = spark.range(1000).select((F.col("id") % 7).alias("a b"), F.when(F.col("id") > 9, F.col("id").cast("string")).alias("t"),
                                  F.lit(None).cast("double").alias("none"))
    out = running.distinct_counts(df, df.columns)
    assert {r["feature"]: r["truth"] for r in out.collect()} == {"a b": 7, "t": 990, "none": 0}
    assert "Expand" not in out._jdf.queryExecution().toString()


def test_forest_tasks_follow_rows_not_shuffle_partitions(spark, monkeypatch):
    """a pass sends every open node's statistics once per task."""
    seen = []

    class Grown(Exception):
        pass

    def fit(self, rows):
        seen.append(rows.rdd.getNumPartitions())
        raise Grown

    monkeypatch.setattr(model.RandomForestClassifier, "fit", fit)
    cores, before = spark.sparkContext.defaultParallelism, spark.conf.get("spark.sql.shuffle.partitions")
    df = spark.range(100).select(F.col("id").cast("double").alias("_ll_f0"), (F.col("id") % 2).alias("Is_Laundering"))
    spark.conf.set("spark.sql.shuffle.partitions", str(cores + 40))
    try:
        for rows in (model.TASK_ROWS, 100 // (cores + 3)):
            monkeypatch.setattr(model, "TASK_ROWS", rows)
            with pytest.raises(Grown):
                model.train_forest(df, 1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == cores and seen[1] == -(-100 // (100 // (cores + 3)))
