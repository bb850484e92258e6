"""SimHash near-duplicates linked through sharded BK-trees.

Method: every document gets a 64-bit SimHash of its word shingles. Distinct fingerprints are
dealt into shards, each shard builds a BK-tree (children keyed by their integer Hamming distance
to the parent) and is searched following only edges within the radius of the query's distance.
Links become connected components of fingerprints, then of documents.

Sharding is exact: of BLOCKS bit blocks, two fingerprints that differ in at most ``radius`` bits
agree in at least BLOCKS - radius blocks, so they share the key of some choice of that many
blocks (7 blocks, 3 equal: 35 keys of 27 or 28 bits). A fingerprint that is alone under a key is
dropped before any tree is built. A tree never holds more than SLICE fingerprints: larger keys
are cut into slices by hash, and every pair of slices meets in a task of its own. The shard
trees therefore live in the tasks that need them; nothing is broadcast that grows with the data.
A task emits only the links that join two of its groups (a spanning forest), so a large group
of near copies gives no pair table.

Defined results: null text, empty text or white space only: fingerprint zero, linked like any
other; fewer words than the shingle length: one shingle, the whole sequence; repeated rows each
get a result; component_id is the smallest non-null id of the component, null if it has none;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import counted_broadcast, materialize, order_hash, require
from .components import connected_components

#: The contract's shingle length, seed and largest bit distance.
SHINGLE, HASH_SEED, RADIUS = 4, 42, 4
BLOCKS = 7
SLICE = 1024

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit set if set in over half of the shingles' XXH64 (A-Z lower-cased, repeats counted)."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []
    if not words:
        return 0
    h, seed = xxhash.xxh64_intdigest, HASH_SEED
    if len(words) <= shingle:
        return h(b" ".join(words), seed)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-shingle])).tolist()
    values = np.array([h(joined[s:e], seed) for s, e in zip(starts, (ends[shingle - 1:] - 1).tolist())], dtype=np.uint64)
    sums = np.zeros(64, dtype=np.int64)
    for at in range(0, len(values), 1 << 16):  # bounded memory on very long texts
        part = values[at:at + (1 << 16)]
        sums += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * sums > len(values)).tolist())


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp): one row per document; fp is the fingerprint as a signed long."""
    require(docs, text, doc_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            fp = [simhash(texts[i].as_py(), shingle) for i in range(batch.num_rows)]
            signed = np.array(fp, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(signed, pa.int64())],
                                             names=["doc_id", "text_hash", "fp"])

    body = F.col(f"`{text}`").cast("string")
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), order_hash(body).alias("text_hash"), body.alias("t"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def block_keys(radius: int, blocks: int = BLOCKS) -> list[int]:
    """Masks of every choice of ``blocks - radius`` of the bit blocks."""
    if not 0 <= radius < blocks:
        raise ValueError(f"the radius must be below {blocks}")
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(masks, blocks - radius)]


class BKTree:
    """Children keyed by their integer Hamming distance to the parent; queries go down in batches."""

    def __init__(self, fps: np.ndarray) -> None:
        self.fps = fps
        self.children: list[dict[int, int]] = []
        for i in range(len(fps)):
            self._insert(i)

    def _insert(self, i: int) -> None:
        self.children.append({})
        if i == 0:
            return
        x, at = int(self.fps[i]), 0
        while True:
            d = (x ^ int(self.fps[at])).bit_count()
            nxt = self.children[at].get(d)
            if nxt is None:
                self.children[at][d] = i
                return
            at = nxt

    def search(self, queries: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """(node, numbers of the queries within the radius of it)."""
        if not len(self.fps):
            return
        todo = [(0, np.arange(len(queries)))]
        while todo:
            node, q = todo.pop()
            d = np.bitwise_count(queries[q] ^ self.fps[node]).astype(np.int16)
            near = q[d <= radius]
            if len(near):
                yield node, near
            for key, child in self.children[node].items():
                follow = q[np.abs(d - key) <= radius]
                if len(follow):
                    todo.append((child, follow))


def forest(fps: np.ndarray, queries: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links between the tree's fingerprints and the queries that join two groups (a spanning forest)."""
    values, at = np.unique(np.concatenate([fps, queries]), return_inverse=True)
    root = list(range(len(values)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links = []
    tree = BKTree(fps)
    for node, near in tree.search(queries, radius):
        a = find(at[node])
        for j in near.tolist():
            b = find(at[len(fps) + j])
            if a != b:
                root[b] = a
                links.append((int(fps[node]), int(queries[j])))
    return links


def links(fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, slice_rows: int = SLICE) -> DataFrame:
    """(a, b): links between distinct fingerprints (column ``fp``) that keep every component together."""
    masks = block_keys(radius, blocks)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in signed]))
                       .alias("choice", "key"))
    sizes = keyed.groupBy("choice", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = counted_broadcast(materialize(sizes, "simhash-sizes"))  # written first: a hot key's join can then be split
    many = keyed.join(sizes, ["choice", "key"])
    # Slices by a hash of the fingerprint; each unordered pair of slices is one search.
    slices = F.ceil(F.col("n") / slice_rows).cast("int")
    many = many.select("fp", "choice", "key", slices.alias("slices"),
                       F.pmod(order_hash(F.col("fp")), slices.cast("long")).cast("int").alias("s"))
    meets = F.transform(F.sequence(F.lit(0), F.col("slices") - 1), lambda o: F.struct(
        F.least(o, F.col("s")).alias("lo"), F.greatest(o, F.col("s")).alias("hi")))
    # Small shards travel together: a bucket of the shard's key is one group of the grouped map.
    spread = many.select("fp", "choice", "key", "s", F.explode(meets).alias("m"))
    spread = spread.select("fp", order_hash(F.col("choice"), F.col("key"), F.col("m.lo"), F.col("m.hi")).alias("shard"),
                           (F.col("s") == F.col("m.lo")).alias("in_tree"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def search(shard, fp, in_tree) -> list[tuple[int, int]]:
            out = []
            cuts = np.flatnonzero(np.diff(shard)) + 1
            for lo, hi in zip(np.concatenate(([0], cuts)).tolist(), np.concatenate((cuts, [len(shard)])).tolist()):
                f, t = fp[lo:hi], in_tree[lo:hi]
                if hi - lo == 2:  # the smallest tree: a root and one query
                    if (int(f[0]) ^ int(f[1])).bit_count() <= radius:
                        out.append((int(f[0]), int(f[1])))
                    continue
                out += forest(f[t], f if t.all() else f[~t], radius)
            return out

        def batch_of(out: list[tuple[int, int]]) -> pa.RecordBatch:
            ab = np.array(out, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(ab[:, 0]), pa.array(ab[:, 1])], names=["a", "b"])

        for batch in batches:  # rows come sorted by shard; the last shard may go on in the next batch
            if not batch.num_rows:
                continue
            carry.append((batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64),
                          batch.column(2).to_numpy(zero_copy_only=False)))
            if carry[0][0][0] == carry[-1][0][-1]:
                continue
            shard, fp, in_tree = (np.concatenate(x) for x in zip(*carry))
            cut = np.searchsorted(shard, shard[-1])
            yield batch_of(search(shard[:cut], fp[:cut], in_tree[:cut]))
            carry = [(shard[cut:], fp[cut:], in_tree[cut:])]
        if carry:
            yield batch_of(search(*(np.concatenate(x) for x in zip(*carry))))

    return spread.repartition("shard").sortWithinPartitions("shard").select("shard", "fp", "in_tree").mapInArrow(
        run, "a long, b long")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE,
                    radius: int = RADIUS) -> DataFrame:
    """(doc_id, text_hash, fp, component_id) for every document."""
    prints = materialize(fingerprints(docs, text, doc_id, shingle), "simhash-docs")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    groups = connected_components(links(distinct.select("fp"), radius))
    member = materialize(distinct.join(groups, distinct["fp"] == groups["node"], "left").select(
        F.col("fp").alias("group_fp"), "first_id", "component"), "simhash-groups")
    linked, alone = member.where("component IS NOT NULL"), member.where("component IS NULL")
    least = materialize(linked.groupBy("component").agg(F.min("first_id").alias("component_id")), "simhash-least")
    member = linked.join(counted_broadcast(least), "component").select("group_fp", "component_id").unionByName(
        alone.select("group_fp", F.col("first_id").alias("component_id")))
    return prints.join(member, F.col("fp") == F.col("group_fp")).drop("group_fp")


def hex_fingerprint(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE,
                         radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` with one document of each component: the one with the smallest id.

    Of rows that share that id, the one with the smallest text hash stays, and one of equal rows.
    """
    require(docs, text, doc_id)
    found = near_duplicates(docs, text, doc_id, shingle, radius)
    # A component without any id has a null component_id: its fingerprint stands for it.
    found = found.withColumn("class", F.coalesce("component_id", "fp")).withColumn("no_id", F.col("component_id").isNull())
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("k")
    kept = found.groupBy("no_id", "class").agg(first).select(
        F.col("k.doc_id").alias("_ll_keep_id"), F.col("k.text_hash").alias("_ll_keep_hash"))
    kept = materialize(kept, "simhash-kept")
    body, key = F.col(f"`{text}`").cast("string"), F.col(f"`{doc_id}`").cast("long")
    stay = docs.join(kept, key.eqNullSafe(F.col("_ll_keep_id")) & (order_hash(body) == F.col("_ll_keep_hash")), "left_semi")
    repeats = found.groupBy("doc_id", "text_hash").count().where("count > 1")
    return stay if repeats.isEmpty() else stay.dropDuplicates([doc_id, text])
