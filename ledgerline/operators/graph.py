"""Directed account graph and per-account features.

The graph is an edge table ``(src, dst, attrs..., batch_id, Index)`` unique on
``(src, dst)``; a repeated transfer overwrites the attributes (last write wins, ordered
by ``(batch_id, Index)``).

Directed clustering (Fagiolo 2007) in closed form: drop self-loops; for each unordered
pair ``{u, v}`` let ``w`` be the number of directions present (1 or 2). For node ``v``,
``dt = sum(w)``, ``db = count(w = 2)``; every undirected triangle gives
``p = w1*w2*w3`` to each of its three corners, and
``C(v) = sum(p) / (dt*(dt-1) - 2*db)`` (0 without a triangle).

Triangles are listed once each by orienting every pair from the lower to the higher
``(undirected degree, id)`` end (Schank & Wagner 2005): a node's oriented out-degree is
at most ``sqrt(2m)``, so a hub account cannot blow up the wedges, and each triangle
appears exactly once. Wedges are closed where they are opened and never shuffled (:func:`corner_sums`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import freeze

# Edge attribute names (payment currency is not kept on edges).
EDGE_ATTRS = ["timestamp", "amount_sent", "amount_received", "received_currency", "payment_format"]
# Most pairs broadcast at once to close wedges (about 130 bytes a row as a hash table, so ~260 MB); the rest follow in rounds.
# At 0 nothing is broadcast here and the wedges meet all pairs in one plain join.
MAX_BROADCAST_EDGES = 2_000_000
# Largest node table broadcast into the orientation joins (two longs a row).
MAX_BROADCAST_NODES = 5_000_000
FEATURE_COLUMNS = ["Node", "degree", "in_degree", "out_degree", "clustering_coefficient", "degree_centrality"]

EDGE_SCHEMA = T.StructType([
    T.StructField("src", T.LongType()), T.StructField("dst", T.LongType()),
    T.StructField("timestamp", T.DoubleType()), T.StructField("amount_sent", T.DoubleType()),
    T.StructField("amount_received", T.DoubleType()), T.StructField("received_currency", T.LongType()),
    T.StructField("payment_format", T.LongType()),
    T.StructField("batch_id", T.LongType()), T.StructField("Index", T.LongType()),
])


def empty_edges(spark: SparkSession) -> DataFrame:
    """G1: a graph with no nodes and no edges."""
    return spark.createDataFrame([], EDGE_SCHEMA)


def last_wins(df: DataFrame) -> DataFrame:
    """A10: one row per (src, dst), attributes of the latest (batch_id, Index)."""
    attrs = F.struct(*[F.col(a) for a in EDGE_ATTRS + ["batch_id", "Index"]])
    order = F.struct(F.col("batch_id"), F.col("Index"))
    agg = df.groupBy("src", "dst").agg(F.max_by(attrs, order).alias("_ll_e"))
    return agg.select("src", "dst", *[F.col(f"_ll_e.{a}").alias(a) for a in EDGE_ATTRS + ["batch_id", "Index"]])


def build_edges(encoded: DataFrame) -> DataFrame:
    """Encoded transfers -> unique attributed edges (last write wins)."""
    bid = F.col("batch_id") if "batch_id" in encoded.columns else F.lit(0).cast("long")
    e = encoded.select(
        F.col("From_ID").alias("src"), F.col("To_ID").alias("dst"),
        F.col("Timestamp").alias("timestamp"), F.col("Amount_Paid").alias("amount_sent"),
        F.col("Amount_Received").alias("amount_received"),
        F.col("Receiving_Currency").alias("received_currency"),
        F.col("Payment_Format").alias("payment_format"),
        bid.cast("long").alias("batch_id"), F.col("Index").cast("long").alias("Index"),
    )
    return last_wins(e.where(F.col("src").isNotNull() & F.col("dst").isNotNull()))


def merge_edges(old: DataFrame, new: DataFrame) -> DataFrame:
    """Compose two graphs; on a shared (src, dst) the later write (right side) wins."""
    return last_wins(old.select(*EDGE_SCHEMA.names).unionByName(new.select(*EDGE_SCHEMA.names)))


def nodes(edges: DataFrame) -> DataFrame:
    """Distinct union of both endpoints."""
    return edges.select(F.explode(F.array("src", "dst")).alias("Node")).distinct()


def graph_counts(edges: DataFrame) -> DataFrame:
    """Number of nodes and edges, as one row."""
    ends = edges.select(F.inline(F.array(
        F.struct(F.col("src").alias("Node"), F.lit(1).alias("e")),
        F.struct(F.col("dst").alias("Node"), F.lit(0).alias("e")))))
    return ends.agg(F.count_distinct("Node").cast("long").alias("n_nodes"),
                    F.sum("e").cast("long").alias("n_edges"))


def pairs(edges: DataFrame) -> DataFrame:
    """Undirected pairs ``u <= v`` with direction flags: ``fwd`` (u->v), ``bwd`` (v->u).

    A self-loop is the pair ``(u, u)`` with both flags 0. One shuffle of the edge table.
    """
    e = edges.select(F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v"),
                     (F.col("src") < F.col("dst")).cast("int").alias("f"),
                     (F.col("src") > F.col("dst")).cast("int").alias("b"))
    return e.groupBy("u", "v").agg(F.max("f").alias("fwd"), F.max("b").alias("bwd"))


def node_stats(edges: DataFrame | None = None, pair_table: DataFrame | None = None) -> DataFrame:
    """G4-G6 plus the clustering denominators, in one aggregation over the pair table:
    Node, out/in/degree, dt (sum of directions, self-loops excluded), db (two-way pairs),
    udeg (distinct neighbours other than itself)."""
    pt = pair_table if pair_table is not None else pairs(edges)
    loop = (F.col("u") == F.col("v")).cast("int")
    other = 1 - loop
    fwd, bwd = F.col("fwd"), F.col("bwd")
    ends = pt.select(F.inline(F.array(
        F.struct(F.col("u").alias("Node"), (fwd + loop).alias("o"), (bwd + loop).alias("i"),
                 (fwd + bwd).alias("w"), (fwd * bwd).alias("two"), other.alias("nb")),
        F.struct(F.col("v").alias("Node"), (bwd * other).alias("o"), (fwd * other).alias("i"),
                 ((fwd + bwd) * other).alias("w"), (fwd * bwd).alias("two"), other.alias("nb")),
    )))
    st = ends.groupBy("Node").agg(
        F.sum("o").cast("long").alias("out_degree"), F.sum("i").cast("long").alias("in_degree"),
        F.sum("w").cast("long").alias("dt"), F.sum("two").cast("long").alias("db"),
        F.sum("nb").cast("long").alias("udeg"))
    return st.withColumn("degree", F.col("in_degree") + F.col("out_degree"))


def triangle_weights(pair_table: DataFrame, stats: DataFrame, n_nodes: int | None = None) -> DataFrame:
    """(Node, tri) where tri = sum over the node's triangles of w1*w2*w3."""
    rank = stats.select(F.col("Node"), F.col("udeg"))
    ru = rank.select(F.col("Node").alias("u"), F.col("udeg").alias("du"))
    rv = rank.select(F.col("Node").alias("v"), F.col("udeg").alias("dv"))
    if n_nodes is not None and n_nodes <= MAX_BROADCAST_NODES:
        ru, rv = F.broadcast(ru), F.broadcast(rv)
    simple = pair_table.where(F.col("u") != F.col("v")).select(
        "u", "v", (F.col("fwd") + F.col("bwd")).alias("w"))
    p = simple.join(ru, "u").join(rv, "v")
    return corner_sums(p, ["w"], lambda x, y, z: x["w"] * y["w"] * z["w"])


def corner_sums(pairs: DataFrame, weights: list[str], value: Callable[[Column, Column, Column], Column],
                counts: Callable[[Column, Column, Column], Column] | None = None) -> DataFrame:
    """(Node, tri): the sum of ``value`` over every node's triangles.

    ``pairs``: every undirected pair once as (u, v, du, dv, weights...), with ``u <> v`` and the ends' degrees.
    ``value`` and ``counts`` (which triangles count, all by default) get the weights of a triangle's three pairs as structs.

    Pairs point from the lower to the higher (degree, id) end and are kept as one list per lower end, at most
    ``sqrt(2m)`` long. Wedges are opened from the lists and closed in place against broadcast pairs, so that
    the wedges, by far the largest table, are never shuffled. A pair can close a wedge only if its lower end is
    some pair's higher end; what is left of them is dealt by that end into as many rounds as the bound on a broadcast asks
    for, and a round opens only the wedges that its pairs can close.
    """
    first = (F.col("du") < F.col("dv")) | ((F.col("du") == F.col("dv")) & (F.col("u") < F.col("v")))
    w = F.struct(*weights).alias("w")
    oriented = pairs.select(
        F.when(first, F.col("u")).otherwise(F.col("v")).alias("lo"),
        F.when(first, F.col("dv")).otherwise(F.col("du")).alias("hd"),
        F.when(first, F.col("v")).otherwise(F.col("u")).alias("hi"), w)
    lists = freeze(oriented.groupBy("lo").agg(F.array_sort(F.collect_list(F.struct("hd", "hi", "w"))).alias("out")), "oriented")
    tops = lists.select(F.explode("out.hi").alias("lo")).distinct()
    closing = freeze(lists.join(tops, "lo", "left_semi").select(F.col("lo").alias("b"), F.inline("out")).select(
        "b", F.col("hi").alias("c"), F.col("w").alias("z")), "closing")
    at_once = MAX_BROADCAST_EDGES
    rounds = max(1, -(-closing.count() // at_once)) if at_once > 0 else 1

    def dealt(node, r: int) -> Column:
        return F.pmod(F.xxhash64(node), F.lit(rounds)) == r if rounds > 1 else F.lit(True)

    def sums(r: int) -> DataFrame:
        ab = lists.where(F.size("out") > 1).select(F.col("lo").alias("a"), "out", F.posexplode("out").alias("i", "e"))
        ab = ab.where(dealt(F.col("e.hi"), r)).select("a", F.col("e.hi").alias("b"), F.col("e.w").alias("x"), F.expr(
            "slice(out, i + 2, size(out))").alias("rest"))
        wedges = ab.select("a", "b", "x", F.explode("rest").alias("f")).select(
            "a", "b", "x", F.col("f.hi").alias("c"), F.col("f.w").alias("y"))
        ends = closing.where(dealt(F.col("b"), r))
        tri = wedges.join(F.broadcast(ends) if at_once > 0 else ends, ["b", "c"])
        ends = [F.col(k) for k in "xyz"]
        if counts is not None:
            tri = tri.where(counts(*ends))
        corners = tri.select(F.explode(F.array("a", "b", "c")).alias("Node"), value(*ends).cast("long").alias("tri"))
        return corners.groupBy("Node").agg(F.sum("tri").cast("long").alias("tri"))

    if rounds == 1:
        return sums(0)
    done = None
    for r in range(rounds):  # one after the other: one broadcast at a time
        part = freeze(sums(r), "triangle-sums")
        done = part if done is None else done.unionByName(part)
    return done.groupBy("Node").agg(F.sum("tri").cast("long").alias("tri"))


def _coefficient():
    """G7 from a node row joined with its triangle sum."""
    den = F.col("dt") * (F.col("dt") - 1) - 2 * F.col("db")
    return F.when(F.coalesce(F.col("tri"), F.lit(0)) > 0, F.col("tri").cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def clustering(edges: DataFrame, stats: DataFrame | None = None, pair_table: DataFrame | None = None,
               n_nodes: int | None = None) -> DataFrame:
    """(Node, clustering_coefficient) for every node of the graph."""
    pair_table = pair_table if pair_table is not None else pairs(edges)
    stats = stats if stats is not None else node_stats(pair_table=pair_table)
    tri = triangle_weights(pair_table, stats, n_nodes)
    return stats.join(tri, "Node", "left").select("Node", _coefficient().alias("clustering_coefficient"))


def graph_tables(edges: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Written pair table and node table, and the node count (the shared first steps)."""
    pt = freeze(pairs(edges), "pairs")
    stats = freeze(node_stats(pair_table=pt), "node-stats")
    return pt, stats, stats.count()


def node_features(edges: DataFrame, nodes_of: DataFrame | None = None, n_nodes: int | None = None) -> DataFrame:
    """The six features, measured on the whole graph, for ``nodes_of`` (J7) or all nodes.

    ``nodes_of`` is any frame with a ``Node`` column (for example the current batch's accounts).
    """
    pt, stats, counted = graph_tables(edges)
    n_nodes = counted if n_nodes is None else n_nodes
    feats = stats.join(triangle_weights(pt, stats, n_nodes), "Node", "left").select(
        F.col("Node").cast("long").alias("Node"),
        F.col("degree").cast("long").alias("degree"),
        F.col("in_degree").cast("long").alias("in_degree"),
        F.col("out_degree").cast("long").alias("out_degree"),
        _coefficient().alias("clustering_coefficient"),
        (F.lit(1.0) if n_nodes <= 1 else F.col("degree").cast("double") / F.lit(float(n_nodes - 1)))
        .alias("degree_centrality"),
    )
    if nodes_of is not None:
        feats = feats.join(nodes_of.select("Node"), "Node", "left_semi")
    return feats


def batch_nodes(encoded: DataFrame) -> DataFrame:
    """Distinct accounts touched by a batch."""
    return encoded.select(F.explode(F.array("From_ID", "To_ID")).alias("Node")).distinct()
