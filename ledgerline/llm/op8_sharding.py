"""Balanced shards by label propagation over linked documents.

Method: documents with equal texts are linked (each to its group, never pair by pair). All
documents start in balanced random shards; then, round by round, a join with the group's
members per shard tells every linked document which shard most of its neighbours are in, and it
asks to move there. Moves are granted under capacity quotas that keep the law ``rows``: shard
counts differ by at most one, always. Unlinked documents have no wishes and make room: they go
where the granted moves leave places. Fewer cut links with unchanged sizes after every round.

A group larger than a shard gets as many target shards as it needs. What reaches the driver is
the wish matrix (``SHARDS`` x ``SHARDS`` counts); ranks for the quotas are taken in bounded windows.

Defined results: null text: size 16, crc32 0, linked to the other null texts; repeated rows are
placed each on its own (linked to one another); null ids are kept; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import counted_broadcast, materialize, order_hash, require
from .ranks import dense_rank_in, unsigned_crc32

SHARDS = 40
#: Bytes counted for a document besides its text.
OVERHEAD = 16
MAX_ROUNDS = 8
#: Rounds end when fewer than this share of the linked documents asks to move.
SETTLED = 0.002


def quotas(wishes: dict[tuple[int, int], int], free: dict[int, int], shards: int) -> tuple[
        dict[tuple[int, int], int], dict[int, int], list[int]]:
    """Granted moves per (from, to), free documents leaving per shard, places they fill per shard.

    A shard can take in what leaves it: its own movers and its free documents. Requests into a
    shard beyond that are cut in proportion until every shard balances.
    """
    x = dict(wishes)
    for _ in range(200):
        into, out = [0] * shards, [0] * shards
        for (i, j), n in x.items():
            into[j] += n
            out[i] += n
        over = {j: into[j] - out[j] - free.get(j, 0) for j in range(shards)}
        over = {j: n for j, n in over.items() if n > 0}
        if not over:
            break
        for j, n in over.items():
            left = n
            for key in sorted((k for k in x if k[1] == j), key=lambda k: (-x[k], k)):
                take = min(x[key], left, -(-n * x[key] // max(1, into[j])))
                x[key] -= take
                left -= take
                if not left:
                    break
    else:
        raise RuntimeError("quotas do not balance")
    leave = {j: into[j] - out[j] for j in range(shards) if into[j] > out[j]}
    fill = [max(0, out[j] - into[j]) for j in range(shards)]
    return {k: n for k, n in x.items() if n}, leave, fill


def _intervals(leave: dict[int, int], fill: list[int]) -> list[tuple[int, int, int, int]]:
    """(from shard, first rank, end rank, to shard): which leaving free documents fill which places."""
    places = [[j, n] for j, n in enumerate(fill) if n]
    out = []
    for i, n in sorted(leave.items()):
        at = 0
        while at < n:
            j, room = places[-1]
            take = min(room, n - at)
            out.append((i, at, at + take, j))
            at += take
            places[-1][1] -= take
            if not places[-1][1]:
                places.pop()
    return out


def assign(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shards: int = SHARDS,
           max_rounds: int = MAX_ROUNDS, seed: int = 42) -> DataFrame:
    """(doc_id, size, text_crc32, group_key, law, shard, slot, grown_shard) for every document."""
    require(docs, text, doc_id)
    spark = docs.sparkSession
    body = F.col(f"`{text}`").cast("string")
    raw = F.coalesce(body, F.lit("")).cast("binary")
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        (F.octet_length(raw) + OVERHEAD).cast("long").alias("size"),
        unsigned_crc32(raw).alias("text_crc32"),
        F.coalesce(F.md5(body.cast("binary")), F.lit("null")).alias("group_key"),
        F.monotonically_increasing_id().alias("row"),  # fixed once written
    )
    rows = materialize(rows, "shard-rows")
    n = rows.count()
    groups = rows.groupBy("group_key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    groups = counted_broadcast(materialize(groups, "shard-groups"))
    state = rows.join(groups, "group_key", "left").withColumn("all", F.lit(0))
    state = materialize(state, "shard-linked")
    state = dense_rank_in(state, ["all"], ["row"], "at", n, seed).select(
        "row", "doc_id", "size", "text_crc32", "group_key", "members", F.pmod("at", F.lit(shards)).cast("int").alias("shard"))
    state = materialize(state, "shard-start")
    capacity = max(1, n // shards)
    for step in range(max_rounds):
        state, asked, linked = _round(spark, state, shards, capacity, n, seed + 1 + step)
        if asked <= SETTLED * linked:
            break
    out = dense_rank_in(state, ["shard"], ["row"], "slot", capacity, seed)
    return out.select("doc_id", "size", "text_crc32", "group_key", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def _round(spark, state: DataFrame, shards: int, capacity: int, n: int, seed: int) -> tuple[DataFrame, int, int]:
    """One round of label propagation: (new state, moves asked for, linked documents)."""
    held = state.where("members IS NOT NULL").groupBy("group_key", "members", "shard").agg(F.count(F.lit(1)).alias("here"))
    # At most ``shards`` rows per group: the shards with most of its members become its targets.
    w = Window.partitionBy("group_key").orderBy(F.desc("here"), order_hash(F.col("group_key"), F.col("shard"), F.lit(seed)))
    placed = held.withColumn("place", F.row_number().over(w))
    wanted = F.ceil(F.col("members") / F.lit(capacity)).cast("int")
    targets = placed.where(F.col("place") <= wanted).groupBy("group_key").agg(F.collect_list("shard").alias("targets"))
    targets = counted_broadcast(materialize(targets, "shard-targets"))
    asked = state.join(targets, "group_key", "left")
    pick = F.get("targets", F.pmod(order_hash(F.col("row"), F.lit(seed)), F.size("targets").cast("long")).cast("int"))
    asked = asked.withColumn("to", F.when(
        F.col("targets").isNotNull() & ~F.array_contains("targets", F.col("shard")), pick)).drop("targets")
    # Queue: movers by (from, to), free documents by (from, -1); the others keep their place.
    queue = F.when(F.col("to").isNotNull(), F.col("to")).when(F.col("members").isNull(), F.lit(-1))
    asked = materialize(asked.withColumn("queue", queue), "shard-asked")
    counts = asked.groupBy("shard", "queue").agg(F.count(F.lit(1)).alias("n")).collect()  # shards x (shards + 2) rows
    wishes = {(r["shard"], r["queue"]): r["n"] for r in counts if r["queue"] is not None and r["queue"] >= 0}
    free = {r["shard"]: r["n"] for r in counts if r["queue"] == -1}
    linked = n - sum(free.values())
    if not wishes:
        return state, 0, linked
    granted, leave, fill = quotas(wishes, free, shards)
    moves = [(i, j, 0, m, j) for (i, j), m in granted.items()]
    moves += [(i, -1, lo, hi, j) for i, lo, hi, j in _intervals(leave, fill)]
    moves = moves or [(-1, -1, 0, 0, -1)]
    table = spark.createDataFrame(moves, "shard int, queue int, lo long, hi long, new int")  # a few rows per shard pair
    queued = materialize(asked.where("queue IS NOT NULL"), "shard-queued")
    longest = max(r["n"] for r in counts if r["queue"] is not None)
    ranked = dense_rank_in(queued, ["shard", "queue"], ["row"], "at", longest, seed)
    moved = ranked.join(F.broadcast(table), ["shard", "queue"]).where("at >= lo AND at < hi").select("row", "new")
    moved = materialize(moved, "shard-moved")
    new = state.join(moved, "row", "left").withColumn("shard", F.coalesce("new", "shard")).drop("new")
    return materialize(new.select(*state.columns), "shard-state"), sum(wishes.values()), linked
