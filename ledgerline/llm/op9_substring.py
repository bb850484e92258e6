"""Substring dedup: recurring passages located with sharded Aho-Corasick automata.

Every word covered by a window of ``WINDOW`` words whose word sequence also starts earlier
(smaller id, or same document and earlier start) is removed; windows are judged on the input.

1. Phrases. Of the ``PHRASE``-word phrases inside every window the one with the smallest hash is
   the window's mark, so equal windows have equal marks; neighbouring windows with one mark form
   a run, about seven windows long. Marks are counted over the whole corpus and joined back: those
   that occur in two runs, or twice in one, are the recurring phrases.
2. Automata. Documents are dealt by hash into shards of about ``SHARD_BYTES`` of text. Each shard
   compiles the recurring phrases of its own documents into one Aho-Corasick automaton and streams
   all its documents through it, which locates every occurrence. An automaton is thus bounded
   by its shard's text, however many phrases the corpus has.
3. Places. Where all runs of a mark have the same words in the whole corpus (the inside of a copied
   passage), a run is one place; elsewhere (at the edges) every window is. Places are keyed by their
   mark and the hash of their words and ranked by (id, start); all but the first are repeats. A shard
   already knows that all but its own first are; only those firsts travel, so a passage sends a row
   per shard at most, however often it occurs. Places whose mark is frequent are ranked in salted
   parts first, then the parts' firsts. The words of the repeats are taken out of the document.

Text travels compressed; whole groups of copies are never gathered.

Defined results: null or empty text: no words, empty kept text; fewer words than a window: all
kept; equal (id, start) places of repeated rows are one place, so repeated rows get equal results;
null ids come first; rows that share an id but not the text are judged as one document's places
and rebuilt separately; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize, order_hash, require

WINDOW, PHRASE = 20, 5
SHARD_BYTES = 1_500_000
#: Documents with a phrase from which on its windows are ranked in parts of about this many.
PART_ROWS = 2_000
#: Bytes of text hashed together in a task.
CHUNK_BYTES = 1_000_000

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * _ODD
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def word_hashes(buffer: bytes) -> np.ndarray:
    """A 64-bit hash of every white-space-delimited word of a buffer, in order."""
    b = np.frombuffer(buffer, dtype=np.uint8)
    at = np.flatnonzero(~_SPACE[b])
    if not len(at):
        return np.empty(0, np.uint64)
    first = np.concatenate(([0], np.flatnonzero(np.diff(at) > 1) + 1))
    sizes = np.diff(np.concatenate((first, [len(at)])))
    place = np.arange(len(at)) - np.repeat(first, sizes)
    powers = np.cumprod(np.full(int(sizes.max()), _ODD, dtype=np.uint64))
    return _mix(np.add.reduceat((b[at].astype(np.uint64) + np.uint64(1)) * powers[place], first))


def phrase_hashes(words: np.ndarray, phrase: int = PHRASE) -> np.ndarray:
    """A 48-bit hash of the phrase starting at every word of one document."""
    n = len(words) - phrase + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for k in range(phrase):
        total = total * np.uint64(0xD6E8FEB86659FD93) + words[k:k + n]
    return _mix(total) >> np.uint64(16)


def slide(f, a: np.ndarray, width: int) -> np.ndarray:
    """``f`` (minimum or maximum) over every ``width`` neighbours."""
    have = 1
    while have < width:
        step = min(have, width - have)
        a = f(a[:-step], a[step:])
        have += step
    return a


def runs(phrases: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring windows with one mark: (first window, windows, mark, whether the mark's phrase comes once).

    A window is ``width`` phrases wide and its mark is the smallest of their hashes. Windows of a run
    in which the phrase comes once are all different.
    """
    if len(phrases) < width:
        none = np.empty(0, np.int64)
        return none, none, np.empty(0, np.uint64), np.empty(0, dtype=bool)
    low = slide(np.minimum, phrases, width)
    at = np.concatenate(([0], np.flatnonzero(low[1:] != low[:-1]) + 1))
    n = np.diff(np.concatenate((at, [len(low)])))
    edge = np.zeros(width - 1, np.uint64)
    is_mark = slide(np.maximum, np.concatenate((edge, low, edge)), width) == phrases
    # Marks sorted by (hash, place): how many of the run's own value lie inside it.
    places = np.flatnonzero(is_mark)
    order = np.lexsort((places, phrases[places]))
    places, values = places[order], phrases[places][order]
    scale = len(phrases) + width
    ranks = np.searchsorted(np.unique(values), values).astype(np.int64) * scale + places
    run_rank = np.searchsorted(np.unique(values), low[at]).astype(np.int64) * scale
    inside = np.searchsorted(ranks, run_rank + at + n + width - 1) - np.searchsorted(ranks, run_rank + at)
    return at, n, low[at], inside == 1


def word_spans(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of the starts and ends of the words of a text joined by single spaces."""
    ends = np.flatnonzero(np.frombuffer(text + b" ", dtype=np.uint8) == 32)
    return np.concatenate(([0], ends[:-1] + 1)), ends


def digests(text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """63-bit hashes of pieces of a text."""
    digest = xxhash.xxh3_64_digest
    found = b"".join([digest(text[a:b]) for a, b in zip(starts.tolist(), ends.tolist())])
    return np.frombuffer(found, dtype=">u8").astype(np.uint64) >> np.uint64(1)


def split_words(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """(text number, word hashes) of every text; short texts are hashed together."""
    lo = 0
    while lo < len(texts):
        hi, size = lo + 1, len(texts[lo])
        while hi < len(texts) and size + len(texts[hi]) <= CHUNK_BYTES:
            size += len(texts[hi])
            hi += 1
        h = word_hashes(b"\n".join(texts[lo:hi]))
        at = 0
        for i in range(lo, hi):
            n = len(texts[i].split())
            yield i, h[at:at + n]
            at += n
        lo = hi


def mark_lists(docs: DataFrame, window: int, phrase: int) -> DataFrame:
    """(shard, marks, keys): mark and words' hash of every run of every document; -1 where a phrase comes again.

    ``docs``: shard, text.
    """
    width = window - phrase + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = [b" ".join((t or "").encode("utf-8").split()) for t in part.column(1).to_pylist()]
                found, keys = [], []
                for i, words in split_words(texts):
                    at, n, mark, once = runs(phrase_hashes(words, phrase), width)
                    starts, ends = word_spans(texts[i])
                    key = digests(texts[i], starts[at], ends[at + n + window - 2]).astype(np.int64)
                    found.append(mark.astype(np.int64))
                    keys.append(np.where(once, key, -1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(found, pa.list_(pa.int64())), pa.array(keys, pa.list_(pa.int64()))],
                    names=["shard", "marks", "keys"])

    return docs.select("shard", "text").mapInArrow(run, "shard int, marks array<long>, keys array<long>")


def packed_texts(docs: DataFrame) -> DataFrame:
    """(shard, id, part, text): the words of every text joined by one space, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                texts = [press.compress(b" ".join((t or "").encode("utf-8").split())) for t in part.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(texts, pa.binary())],
                                                 names=["shard", "id", "part", "text"])

    return docs.select("shard", "id", "part", "text").mapInArrow(run, "shard int, id long, part long, text binary")


def locate(texts: list[bytes], recurring: np.ndarray, counts: np.ndarray, mixed: np.ndarray, window: int, phrase: int) -> Iterator[
        tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For every text its places with a recurring mark: first window, windows, mark, words' hash, count of the mark.

    ``recurring``: sorted phrase hashes, with their counts and whether their runs differ.
    """
    width = window - phrase + 1
    hashed = []
    automaton = ahocorasick.Automaton()
    none = np.empty(0, np.int64)

    def place(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(recurring, marks), max(0, len(recurring) - 1))
        return at, recurring[at] == marks if len(recurring) else np.zeros(len(marks), dtype=bool)

    for i, words in split_words(texts):
        p = phrase_hashes(words, phrase)
        at, n, mark, _ = runs(p, width)
        starts, ends = word_spans(texts[i])
        hashed.append((p, at, n, mark, starts, ends))
        wanted = place(mark)[1]
        for k, m in zip(at[wanted].tolist(), mark[wanted]):
            first = k + int(np.argmax(p[k:k + width] == m))
            automaton.add_word(" " + texts[i][starts[first]:ends[first + phrase - 1]].decode("utf-8") + " ", 0)
    if len(automaton):
        automaton.make_automaton()
    for (p, at, n, mark, starts, ends), t in zip(hashed, texts):
        if not len(automaton) or not len(at):
            yield none, none, none, none, none
            continue
        body = " " + t.decode("utf-8") + " "
        hits = np.fromiter((e for e, _ in automaton.iter(body)), np.int64)
        spaces = np.flatnonzero(np.frombuffer(body.encode("utf-32-le"), dtype=np.uint32) == 32)
        flagged = np.full(len(p), _NONE)
        located = np.searchsorted(spaces, hits) - phrase
        flagged[located] = p[located]
        found = slide(np.minimum, flagged, width)[at] == mark
        at, n, mark = at[found], n[found], mark[found]
        row = place(mark)[0]
        one = ~mixed[row]
        # Runs of uniform marks stay whole, the others come window by window.
        each = np.where(one, 1, n)
        first = np.repeat(at, each) + (np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each))
        size = np.repeat(np.where(one, n, 1), each)
        key = digests(t, starts[first], ends[first + size + window - 2])
        yield first, size, np.repeat(mark, each), key, np.repeat(counts[row], each)


def places(docs: DataFrame, need: DataFrame, window: int, phrase: int, part_rows: int) -> DataFrame:
    """(id, part, text, known, starts, sizes, marks, keys, salts) of every document: its places with a recurring mark.

    ``known``: places (first window and windows as one number) that also come earlier in the shard; the
    other columns hold the rest. ``salts`` is -1 where the place is ranked in one piece, else the
    document's part number.
    """
    schema = ("id long, part long, text binary, known array<long>, starts array<int>, sizes array<int>, marks array<long>, "
              "keys array<long>, salts array<int>")

    def run(_, docs, need):
        h, n = need.column("mark").to_numpy().astype(np.uint64), need.column("n").to_numpy()
        mixed = need.column("mixed").to_numpy(zero_copy_only=False).astype(bool)
        order = np.argsort(h)
        h, n, mixed = h[order], n[order], mixed[order]
        texts = [zstandard.decompress(t) for t in docs.column("text").to_pylist()]
        ids = docs.column("id").to_pylist()
        found = [tuple(x.astype(np.int64) for x in place) for place in locate(texts, h, n, mixed, window, phrase)]
        at, size, mark, key, counts = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 5
        doc = np.repeat(np.arange(len(found)), [len(place[0]) for place in found])
        # Rank of the documents by id, null first; equal ids share a rank.
        known_ids = sorted({i for i in ids if i is not None})
        rank = np.array([0 if i is None else 1 + int(np.searchsorted(known_ids, i)) for i in ids], dtype=np.int64)[doc]
        order = np.lexsort((at, rank, key, mark))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (mark[order][1:] != mark[order][:-1]) | (key[order][1:] != key[order][:-1])
        lead = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))] if len(order) else order
        late = np.zeros(len(order), dtype=bool)
        late[order] = (rank[order] != rank[lead]) | (at[order] != at[lead])
        parts = -(-counts // part_rows)
        deal = np.array([xxhash.xxh3_64_intdigest(f"{i}") >> 2 for i in ids], dtype=np.int64)[doc]
        salt = np.where(parts > 1, deal % np.maximum(parts, 1), -1)

        def lists(values: np.ndarray, keep: np.ndarray, kind: pa.DataType) -> pa.Array:
            ends = np.cumsum(np.bincount(doc[keep], minlength=len(texts)))
            return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(values[keep], kind))

        cols = [lists((at << 31) | size, late, pa.int64())] + [
            lists(x, ~late, k) for x, k in ((at, pa.int32()), (size, pa.int32()), (mark, pa.int64()), (key, pa.int64()), (salt, pa.int32()))]
        return pa.Table.from_arrays([docs.column("id"), docs.column("part"), docs.column("text"), *cols],
                                    names=["id", "part", "text", "known", "starts", "sizes", "marks", "keys", "salts"])

    return docs.groupBy("shard").cogroup(need.groupBy("shard")).applyInArrow(run, schema)


def ranked_places(found: DataFrame) -> DataFrame:
    """(id, part, at, late, a, b): places that are not the first of their part, and firsts of salted parts."""
    rows = found.where(F.size("starts") > 0).select(
        "id", "part", F.explode(F.arrays_zip("starts", "sizes", "marks", "keys", "salts")).alias("w"))
    # First window and windows as one number: fewer bytes to shuffle, and the same order.
    rows = rows.select("id", "part", F.shiftleft(F.col("w.starts").cast("long"), 31).bitwiseOR(F.col("w.sizes").cast("long")).alias("at"),
                       F.col("w.marks").alias("a"), F.col("w.keys").alias("b"), F.col("w.salts").alias("salt"))
    order = [F.col("id").asc_nulls_first(), F.col("at")]
    late = F.rank().over(Window.partitionBy("a", "b", "salt").orderBy(*order)) > 1
    ranked = rows.withColumn("late", late).where("late OR salt >= 0")
    # Firsts of a part meet once more; the others only need their place.
    return materialize(ranked.select("id", "part", "at", "late", F.when(~F.col("late"), F.col("a")).alias("a"),
                                     F.when(~F.col("late"), F.col("b")).alias("b")), "passages-ranked")


def repeats(ranked: DataFrame) -> DataFrame:
    """(id, part, gone): first window and windows, as one number, of the places that also come earlier."""
    order = [F.col("id").asc_nulls_first(), F.col("at")]
    firsts = ranked.where("NOT late").withColumn("k", F.rank().over(Window.partitionBy("a", "b").orderBy(*order)))
    all_late = ranked.where("late").select("id", "part", "at").unionByName(firsts.where("k > 1").select("id", "part", "at"))
    return all_late.groupBy("id", "part").agg(F.collect_set("at").alias("gone"))


def dedup_passages(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = WINDOW, phrase: int = PHRASE,
                   shard_bytes: int = SHARD_BYTES, part_rows: int = PART_ROWS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) of every document; kept words are joined by one space."""
    require(docs, text, doc_id)
    body = F.col(f"`{text}`").cast("string")
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), body.alias("text"))
    total = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    shards = max(1, -(-total // shard_bytes))
    # Only where ids repeat does a row need its text's hash beside the id.
    unique = rows.groupBy("id").count().where("count > 1").isEmpty()
    part = F.lit(0).cast("long") if unique else F.coalesce(order_hash(F.col("text")), F.lit(0))
    rows = rows.select(F.pmod(order_hash(F.col("id"), part), F.lit(shards)).cast("int").alias("shard"), "id",
                       part.alias("part"), "text")
    listed = materialize(mark_lists(rows, window, phrase), "passages-marks")
    one = listed.select("shard", F.explode(F.arrays_zip("marks", "keys")).alias("m")).select(
        "shard", F.col("m.marks").alias("mark"), F.col("m.keys").alias("key"))
    often = one.groupBy("mark").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
    often = often.where("n > 1 OR low < 0").select("mark", "n", F.expr("low < 0 OR low <> high").alias("mixed"))
    often = materialize(often, "passages-often")
    need = materialize(one.select("shard", "mark").distinct().join(often, "mark"), "passages-need")
    discard(listed, often)
    found = materialize(places(packed_texts(rows), need, window, phrase, part_rows), "passages-places")
    discard(need)
    ranked = ranked_places(found)
    gone = materialize(repeats(ranked), "passages-gone")
    discard(ranked)
    clean = found.where(F.size("starts") == 0).select("id", "text", F.col("known").alias("gone"))
    gone = gone.select(F.col("id").alias("id_"), F.col("part").alias("part_"), "gone")
    hit = found.where(F.size("starts") > 0).select("id", "part", "text", "known").join(
        gone, F.col("id").eqNullSafe(F.col("id_")) & (F.col("part") == F.col("part_")), "left").select(
        "id", "text", F.when(F.col("gone").isNull(), F.col("known")).otherwise(F.concat("known", "gone")).alias("gone"))

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                b = batch.slice(lo, 512)
                n, removed, kept = [], [], []
                for blob, starts in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                    t = zstandard.decompress(blob)
                    words = t.split()
                    n.append(len(words))
                    if not starts:
                        removed.append(0)
                        kept.append(t.decode("utf-8"))
                        continue
                    edge = np.zeros(len(words) + 1, np.int64)
                    at = np.array(starts)
                    np.add.at(edge, at >> 31, 1)
                    np.add.at(edge, (at >> 31) + (at & 0x7FFFFFFF) + window - 1, -1)
                    out = np.cumsum(edge[:-1]) > 0
                    removed.append(int(out.sum()))
                    kept.append(b" ".join([w for w, x in zip(words, out.tolist()) if not x]).decode("utf-8"))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                                                  pa.array(kept, pa.string())],
                                                 names=["doc_id", "n_words", "n_removed", "kept_text"])

    return clean.unionByName(hit).mapInArrow(rebuild, "doc_id long, n_words long, n_removed long, kept_text string")


ORACLE_SQL = f"""
WITH d AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') IF x <> ''] AS w FROM documents
), win AS (
  SELECT doc_id, s, array_to_string(w[s:s + {WINDOW - 1}], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS s FROM d WHERE len(w) >= {WINDOW})
), late AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM win) WHERE r > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + {WINDOW})) AS p FROM late
), words AS (
  SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d
), kept AS (
  SELECT words.doc_id, string_agg(x, ' ' ORDER BY words.p) AS t, count(*) AS n
  FROM words ANTI JOIN gone ON gone.doc_id = words.doc_id AND gone.p = words.p GROUP BY words.doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""
