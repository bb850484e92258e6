"""Hand-made golden graphs (closed-form expectations) and a brute-force clustering check."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.graph import build_edges, merge_edges, node_features


def encoded(spark, edges):
    rows = [(i, s, d, float(i), float(a), 0, float(a), 0, 0, 0, 0) for i, (s, d, a) in enumerate(edges)]
    return spark.createDataFrame(rows, "Index long, From_ID long, To_ID long, Timestamp double, Amount_Paid double, "
                                       "Payment_Currency long, Amount_Received double, Receiving_Currency long, "
                                       "Payment_Format long, Is_Laundering long, batch_id long")


def feats(spark, edges):
    e = build_edges(encoded(spark, [(s, d, 1) for s, d in edges]))
    return {r["Node"]: r for r in node_features(e).collect()}


def test_directed_three_cycle(spark):
    f = feats(spark, [(1, 2), (2, 3), (3, 1)])
    for n in (1, 2, 3):
        assert f[n]["clustering_coefficient"] == pytest.approx(0.5)
        assert f[n]["degree"] == 2 and f[n]["degree_centrality"] == pytest.approx(1.0)


def test_full_two_way_triangle(spark):
    f = feats(spark, [(a, b) for a in (1, 2, 3) for b in (1, 2, 3) if a != b])
    for n in (1, 2, 3):
        assert f[n]["clustering_coefficient"] == pytest.approx(1.0)
        assert f[n]["degree"] == 4 and f[n]["degree_centrality"] == pytest.approx(2.0)


def test_two_cycle(spark):
    f = feats(spark, [(1, 2), (2, 1)])
    assert f[1]["clustering_coefficient"] == 0.0 and f[1]["degree"] == 2
    assert f[1]["degree_centrality"] == pytest.approx(2.0)


def test_star(spark):
    f = feats(spark, [(0, 1), (0, 2), (0, 3)])
    assert (f[0]["out_degree"], f[0]["in_degree"]) == (3, 0)
    assert f[0]["degree_centrality"] == pytest.approx(1.0)
    assert f[1]["degree_centrality"] == pytest.approx(1 / 3)
    assert all(r["clustering_coefficient"] == 0.0 for r in f.values())


def test_self_loop_and_edge(spark):
    f = feats(spark, [(1, 1), (1, 2)])
    assert (f[1]["degree"], f[1]["in_degree"], f[1]["out_degree"]) == (3, 1, 2)
    assert f[1]["clustering_coefficient"] == 0.0
    assert f[1]["degree_centrality"] == pytest.approx(3.0)


def test_single_self_loop(spark):
    f = feats(spark, [(7, 7)])
    assert f[7]["degree"] == 2 and f[7]["degree_centrality"] == pytest.approx(1.0)


def test_repeat_edge_last_write_wins(spark):
    e = build_edges(encoded(spark, [(1, 2, 1), (1, 2, 2)])).collect()
    assert len(e) == 1 and e[0]["amount_sent"] == 2.0


def test_merge_right_side_wins_and_is_idempotent(spark):
    a = build_edges(encoded(spark, [(1, 2, 1), (2, 3, 1)]))
    b = build_edges(encoded(spark, [(1, 2, 5)]).withColumn("batch_id", F.lit(1).cast("long")))
    m = {(r["src"], r["dst"]): r["amount_sent"] for r in merge_edges(a, b).collect()}
    assert m == {(1, 2): 5.0, (2, 3): 1.0}
    again = {(r["src"], r["dst"]): r["amount_sent"] for r in merge_edges(merge_edges(a, b), b).collect()}
    assert again == m


def naive_clustering(edges):
    """Neighbour-set enumeration of the directed clustering coefficient (self-loops ignored)."""
    nodes = {x for e in edges for x in e}
    succ = {n: {d for s, d in edges if s == n and d != n} for n in nodes}
    pred = {n: {s for s, d in edges if d == n and s != n} for n in nodes}
    out = {}
    for i in nodes:
        t = 0
        for j in list(pred[i]) + list(succ[i]):
            t += len(pred[i] & pred[j]) + len(pred[i] & succ[j]) + len(succ[i] & pred[j]) + len(succ[i] & succ[j])
        dt = len(pred[i]) + len(succ[i])
        db = len(pred[i] & succ[i])
        den = 2 * (dt * (dt - 1) - 2 * db)
        out[i] = t / den if t > 0 else 0.0
    return out


@pytest.mark.parametrize("seed", range(6))
def test_clustering_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    n = rnd.randint(5, 14)
    edges = sorted({(rnd.randrange(n), rnd.randrange(n)) for _ in range(rnd.randint(n, 4 * n))})
    f = feats(spark, edges)
    want = naive_clustering(edges)
    for node, v in want.items():
        assert f[node]["clustering_coefficient"] == pytest.approx(v, abs=1e-12), (seed, node)


def test_all_pairs_graph_counts(spark):
    from ledgerline.operators.graph import graph_counts
    edges = list(itertools.permutations(range(4), 2))
    e = build_edges(encoded(spark, [(s, d, 1) for s, d in edges]))
    r = graph_counts(e).first()
    assert (r["n_nodes"], r["n_edges"]) == (4, 12)


@pytest.mark.parametrize("limit", [20, 10**6])
def test_wedges_are_closed_in_place_at_any_size(spark, monkeypatch, limit):
    from ledgerline.operators import graph as g
    monkeypatch.setattr(g, "MAX_BROADCAST_EDGES", limit)
    plans, plain = [], g.freeze

    def kept(df, name, *rest):
        if name == "triangle-sums":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return plain(df, name, *rest)

    monkeypatch.setattr(g, "freeze", kept)
    rnd = random.Random(11)
    edges = sorted({(rnd.randrange(16), rnd.randrange(16)) for _ in range(90)})
    e = build_edges(encoded(spark, [(s, d, 1) for s, d in edges]))
    pt, stats, n = g.graph_tables(e)
    got = {r["Node"]: r["clustering_coefficient"] for r in g.clustering(None, stats, pt, n).collect()}
    assert got == {k: pytest.approx(v, abs=1e-12) for k, v in naive_clustering(edges).items()}
    last = g.triangle_weights(pt, stats, n)._jdf.queryExecution().executedPlan().toString()
    assert all("SortMergeJoin" not in x and "BroadcastHashJoin" in x for x in plans) and (len(plans) > 1) == (limit == 20)
    assert "SortMergeJoin" not in last
