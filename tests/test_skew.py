"""Hot keys: a third of all rows on one key must not change results."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.graph import build_edges, node_features
from ledgerline.operators.rank import with_row_index
from test_graph_golden import encoded, naive_clustering


def test_row_index_with_hot_leading_key(spark):
    n = 9000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 17 + 1).alias("k"),
                               (F.col("id") * 7919 % n).alias("v"))
    idx = with_row_index(df, ["k", "v"], name="i", num_partitions=6)
    rows = sorted((r["k"], r["v"], r["i"]) for r in idx.collect())
    assert [i for _, _, i in rows] == list(range(n))
    sizes = idx.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < n  # the hot key is spread, not one task


@pytest.mark.parametrize("seed", [1, 2])
def test_clustering_with_hub_account(spark, seed):
    rnd = random.Random(seed)
    n = 40
    edges = {(rnd.randrange(n), rnd.randrange(n)) for _ in range(120)}
    hub = 0
    edges |= {(hub, d) for d in range(1, n)} | {(s, hub) for s in range(1, n, 2)}  # ~a third of all edges
    edges = sorted(edges)
    e = build_edges(encoded(spark, [(s, d, 1) for s, d in edges]))
    got = {r["Node"]: r["clustering_coefficient"] for r in node_features(e).collect()}
    for node, v in naive_clustering(edges).items():
        assert got[node] == pytest.approx(v, abs=1e-12)
