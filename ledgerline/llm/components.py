"""Connected components by alternating large-star and small-star joins.

Works on an edge table of two long columns; every round is four shuffles of the remaining
edges, and the number of rounds grows with the logarithm of the longest chain. Nothing is
collected: the loop looks at one count and one checksum per round. A hub's edges are joined
with one row (its minimum): the minima are written first, so the join is a broadcast of a counted
table or one whose hot side Spark's skew join can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import counted_broadcast, materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    low = counted_broadcast(materialize(low, "cc-low"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    low = counted_broadcast(materialize(down.groupBy("a").agg(F.min("b").alias("m")), "cc-low"))
    to = down.join(low, "a")
    return to.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(
        low.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has an edge to another.

    ``edges``: columns ``a`` and ``b`` (long, not null), in any order, repeats and loops allowed.
    Raises if ``max_rounds`` rounds are not enough, rather than return unfinished groups.
    """
    now = materialize(edges.select("a", "b").where("a <> b").distinct(), "cc-edges")
    seen = None
    for _ in range(max_rounds):
        now = materialize(_small_star(_large_star(now)), "cc-round")
        state = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())
        if state == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        seen = state
    raise RuntimeError(f"components not settled after {max_rounds} rounds")
