"""Target-distribution importance resampling: documents drawn by how much more likely the target is to hold their n-grams.

Features are all runs of 1 to ``GRAMS`` words, hashed into ``BUCKETS`` buckets. The source (all documents) and the
target are counted into one array each; a bucket's gain is the floored, scaled logarithm of the ratio
of its smoothed shares. A document's weight is the sum of its features' gains, read from the array
of gains, which has a fixed size whatever the corpus. Its score adds Gumbel noise made from a hash of its
id, so that the highest scores are a draw without replacement in proportion to exp(weight / SCALE).

The k highest scores are found by distributed quickselect: each round takes random keys among the rows still
open, counts exactly how many rows come before, at and after each, and keeps the stretch that holds the
k-th; only the winners are sorted (range-partitioned) and ranked.

Defined results: null or empty text: no words, no features, weight 0, never drawn; a null id hashes as an
empty text and comes before other ids on ties; repeated rows count each time, are drawn one by one and
get neighbouring ranks; extra columns are ignored; an empty target leaves gains from the source alone; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.rank import with_row_index
from .common import materialize, order_hash, require

GRAMS, BUCKETS, SCALE = 3, 10_000, 1_000
#: Documents with fewer words are never drawn.
MIN_WORDS = 20
#: Of every hundred eligible documents.
DRAW_PERCENT = 5
SEED = "42"
#: Random keys of a round of the quickselect.
PIVOTS = 24

#: A-Z become a-z; bytes that are not letters, digits or part of a longer character become spaces.
_FOLD = bytes((c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32) for c in range(256))
#: Features hashed at a time.
_STEP = 200_000


def feature_buckets(text: bytes, grams: int = GRAMS, buckets: int = BUCKETS) -> Iterator[np.ndarray]:
    """The buckets of all features of a text, in pieces of about _STEP words; the first piece may be empty."""
    words = text.translate(_FOLD).split()
    for lo in range(0, max(1, len(words)), _STEP):
        part = words[lo:lo + _STEP + grams - 1]
        n = min(len(words) - lo, _STEP)
        found = [np.fromiter(map(crc32, part[:n]), np.uint32, n)]
        later = [b" " + w for w in part]
        state = found[0].tolist()
        for g in range(1, grams):  # the checksum of one more word goes on from that of the words before
            state = list(map(crc32, later[g:], state))[:n]
            found.append(np.array(state, np.uint32))
        yield (np.concatenate(found) % np.uint32(buckets)).astype(np.int64)


def _word_count(text: bytes) -> int:
    return len(text.translate(_FOLD).split())


def _texts(column: pa.Array) -> Iterator[bytes]:
    for t in column:
        yield t.as_buffer().to_pybytes() if t.is_valid else b""


def bucket_counts(texts: DataFrame, column: str = "text", grams: int = GRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into every bucket. Each task adds up its own array first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in _texts(batch.column(0)):
                for found in feature_buckets(text, grams, buckets):
                    total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    rows = texts.select(F.col(f"`{column}`").cast("string")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row per bucket: a fixed number
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Floored scaled log ratio of the smoothed shares of every bucket."""
    s_all, t_all, n = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(scale * math.log((t + 1) * (s_all + n) / ((s + 1) * (t_all + n))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, text: str, doc_id: str, grams: int = GRAMS) -> DataFrame:
    """(doc_id, n_features, weight, n_words) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, total, words = [], [], []
            for t in _texts(batch.column(1)):
                count = value = 0
                for found in feature_buckets(t, grams, len(gain)):
                    count += len(found)
                    value += int(gain[found].sum())
                n.append(count)
                total.append(value)
                words.append(_word_count(t))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in (n, total, words))],
                                             names=["doc_id", "n_features", "weight", "n_words"])

    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_features long, weight long, n_words long")


def gumbel(doc_id: Column, seed: str = SEED, scale: int = SCALE) -> Column:
    """Floored scaled Gumbel noise from the first 32 bits of a hash of seed and id."""
    name = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-float(scale)) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


KEY = ["a", "b", "c"]


def _literal(key: tuple) -> Column:
    return F.struct(*[F.lit(v).cast("long").alias(n) for n, v in zip(KEY, key)])


def kth_key(keys: DataFrame, k: int, pivots: int = PIVOTS) -> tuple | None:
    """The k-th smallest (from 1) of the composite keys (a, b, c), which must be unique; None for k < 1.

    ``keys``: a written table of the three long columns, in which nulls come first. A round counts the
    rows before every one of ``pivots`` random keys; each leaves about 1 / pivots of the rows. When no
    more than ``pivots`` rows are open, all of them are pivots, so the k-th is among them.
    """
    if k < 1:
        return None
    here = F.struct(*KEY)
    open_rows, turn = keys, 0
    while True:
        at = open_rows.select(*KEY).orderBy(order_hash(F.col("c"), F.lit(turn)), "c").limit(pivots)
        chosen = at.orderBy(here).collect()  # ``pivots`` rows
        tried = [tuple(r) for r in chosen]
        sums = open_rows.agg(*[F.struct(F.count_if(here < _literal(p)), F.count_if(here == _literal(p))).alias(f"n{i}")
                               for i, p in enumerate(tried)]).first()
        before = [(s[0], s[1]) for s in sums]
        low = high = None
        skip = 0
        for p, (less, equal) in zip(tried, before):
            if less < k <= less + equal:
                return p
            if less + equal < k:
                low, skip = p, less + equal
            else:
                high = p
                break
        if low is not None:
            open_rows = open_rows.where(here > _literal(low))
        if high is not None:
            open_rows = open_rows.where(here < _literal(high))
        open_rows = materialize(open_rows.select(*KEY), "resample-open")
        k, turn = k - skip, turn + 1


def resample(docs: DataFrame, target: DataFrame, text: str = "text", doc_id: str = "doc_id", target_text: str = "text",
             percent: int = DRAW_PERCENT, min_words: int = MIN_WORDS, seed: str = SEED, grams: int = GRAMS,
             buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_features, weight, score, rank, n_words) of every document; ``rank`` is null for those not drawn."""
    require(docs, text, doc_id)
    require(target, target_text)
    gain = gains(bucket_counts(docs, text, grams, buckets), bucket_counts(target, target_text, grams, buckets))
    scored = weights(docs, gain, text, doc_id, grams)
    # The row number is written with the row, so it stays what it is; it tells repeated rows apart.
    scored = materialize(scored.select(
        "doc_id", "n_features", "weight", (F.col("weight") + gumbel(F.col("doc_id"), seed)).alias("score"), "n_words",
        F.monotonically_increasing_id().alias("row")), "resample-scored")
    eligible = scored.where(F.col("n_words") >= min_words)
    keyed = eligible.select((-F.col("score")).alias("a"), F.col("doc_id").alias("b"), F.col("row").alias("c"))
    last = kth_key(keyed, percent * eligible.count() // 100)
    cols = [F.col(c) for c in ("doc_id", "n_features", "weight", "score")]
    none = F.lit(None).cast("long").alias("rank")
    if last is None:
        return scored.select(*cols, none, "n_words")
    key = F.struct((-F.col("score")).alias("a"), F.col("doc_id").alias("b"), F.col("row").alias("c"))
    won = (F.col("n_words") >= min_words) & (key <= _literal(last))
    ranked = with_row_index(scored.where(won), [F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("row")],
                            name="rank", start=1)
    return scored.where(~won).select(*cols, none, "n_words").unionByName(ranked.select(*cols, "rank", "n_words"))
