"""Quality classifier: interpolated modified Kneser-Ney character n-grams trained on trusted text.

Method: n-gram counts of all trusted documents (label: good quality, not toxic) are summed in
Spark; continuation counts, discounts and back-off weights come from joins of the count tables
on the context (sharded by it); every document gets its perplexity under the model, and is kept
when that is not above a quantile of the trusted documents of its own language.

Orders ``DEEP`` and ``DEEP - 1`` are n-grams of the characters as they stand, so the model grows with
the trusted text. Below them a model over ``SYMBOLS`` classes of characters (order ``ORDER``, shared
out evenly within a class) gives every character a probability, also those never seen.

A trusted document is scored without its own n-grams (leave one out): its share of an n-gram's count is
taken off, and what only it holds is left to the lower order. Otherwise the quantile would be that of
learned text and too strict for text like it.

Scale. A slice of text (what a task reads, up to SLICE_CHARS) sends the 64-bit keys of its distinct n-grams, packed per
bucket of keys, to the count tables, which are sharded by the same buckets; the rows found go back to the slice's own
compressed text, where they are looked up per n-gram and the bits summed per document. Shares and weights travel
as 32-bit floats. No table of the characters' own n-grams is broadcast or reaches the driver, nor any table of the
places of n-grams written. Documents are scored in ``PASSES`` passes by a hash of their id, each over the whole model:
keys, rows found and compressed text are on disk for one pass at a time. Only the class model is broadcast: it has at most
``SYMBOLS ** ORDER`` entries (5.3 million, 21 MB as floats) however large the corpus is.

Defined results: null or empty text: perplexity null and not kept; a null language forms its own
class ``und``; a language without trusted text uses the quantile over all trusted documents; no
trusted text at all: perplexity null and every non-empty document kept; several labels for one id:
trusted only if all of them are; repeated rows each get the same result; a null id is never
trusted; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import counted_broadcast, discard, materialize, require, shuffle_partitions

#: Highest order over characters; the classes of characters below have theirs.
DEEP = 6
ORDER = 4
SYMBOLS = 48
#: A document is kept up to this quantile of the trusted documents' perplexity in its language.
QUANTILE = 0.995
#: Characters handled together in a task.
CHUNK_CHARS = 1_000_000
#: Distinct n-grams in a batch of results, those a task holds before it merges them, and merged ones before it sends them.
ROWS = 20_000
HELD, MERGED = 600_000, 4_000_000
#: Characters whose n-grams ask for the model's rows together.
SLICE_CHARS = 64_000_000
#: Passes over the documents in scoring (fewer while a pass has less than PASS_CHARS characters), and characters of a task.
PASSES, PASS_CHARS, TASK_CHARS = 4, 20_000_000, 12_000_000
#: Rows of the model, and characters of text, per bucket of keys.
BUCKET_ROWS, BUCKET_CHARS = 200_000, 20_000_000
#: Multiplier of the n-grams' keys.
FACTOR = np.uint64(0xD6E8FEB86659FD93)
#: Resolution of the quantile in log2 perplexity.
STEPS = 1000

_TABLE: list[np.ndarray] = []
_BITS: list[np.ndarray] = []


def _symbol_table() -> np.ndarray:
    """Code point -> symbol. 0 white space, 1-26 letters, 27 digit, 28 newline, 29 full stop, 30 comma,
    31 and 32 other ASCII marks (two classes), 33 other marks, 34-47 other letters by code point."""
    if not _TABLE:
        t = np.full(0x110000, 33, dtype=np.int32)
        other = np.fromiter((chr(i).isalpha() for i in range(0x80, 0x3000)), dtype=bool, count=0x3000 - 0x80)
        points = np.arange(0x80, 0x110000)
        letters = np.concatenate([other, np.ones(0x110000 - 0x3000, dtype=bool)])
        t[0x80:] = np.where(letters, 34 + points % 14, 33)
        t[:0x80] = 31
        for ch in "#*$%&|<>{}[]\\^~_=+@":
            t[ord(ch)] = 32
        for i in range(26):
            t[ord("a") + i] = t[ord("A") + i] = 1 + i
        for i in range(10):
            t[ord("0") + i] = 27
        for ch in " \t\x0b\f\r\x85\xa0":
            t[ord(ch)] = 0
        t[ord("\n")], t[ord(".")], t[ord(",")] = 28, 29, 30
        _TABLE.append(t)
    return _TABLE[0]


def gram_ids(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, n-gram id) of every character, with ORDER - 1 spaces before each text."""
    pad = " " * (ORDER - 1)
    cp = np.frombuffer("".join([pad + t for t in texts]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    s = _symbol_table()[cp]
    sizes = np.array([len(t) + ORDER - 1 for t in texts])
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    if len(s) < ORDER:
        return doc[:0], s[:0]
    g = s[:-(ORDER - 1)].copy()
    for k in range(1, ORDER):
        g *= SYMBOLS
        g += s[k:len(s) - (ORDER - 1) + k]
    inside = doc[:-(ORDER - 1)] == doc[ORDER - 1:]
    return doc[ORDER - 1:][inside], g[inside]


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    lo = chars = 0
    for i, t in enumerate(texts):
        if i > lo and chars + len(t or "") > CHUNK_CHARS:
            yield lo, i
            lo, chars = i, 0
        chars += len(t or "")
    if texts:
        yield lo, len(texts)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids whose labels all say good quality and not toxic."""
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    return (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("trusted_id"))
            .agg(F.min(F.coalesce(good, F.lit(False))).alias("ok")).where("ok").select("trusted_id"))


def gram_counts(texts: DataFrame) -> DataFrame:
    """(g, n): counts of the highest-order n-grams of a one-column table of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            rows = batch.column(0).to_pylist()
            for lo, hi in _chunks(rows):
                _, g = gram_ids([t or "" for t in rows[lo:hi]])
                got = np.bincount(g, minlength=SYMBOLS ** ORDER)
                total = got if total is None else total + got
        if total is not None:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["g", "n"])

    return texts.mapInArrow(run, "g long, n long").groupBy("g").agg(F.sum("n").alias("n"))


def discounted(level: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(g, n, alpha) discounted share of each n-gram and (ctx, gamma) back-off weight of each context of (g, ctx, n).

    Discounts follow the counts of counts; where those are missing or give a value outside 0..k,
    half of the count class is taken off.
    """
    t = level.agg(*[F.count(F.when(F.col("n") == i, 1)).alias(f"t{i}") for i in (1, 2, 3, 4)])
    y = F.when(F.col("t1") > 0, F.col("t1") / (F.col("t1") + 2 * F.col("t2")))
    raw = [F.lit(i) - (i + 1) * y * F.col(f"t{i + 1}") / F.when(F.col(f"t{i}") > 0, F.col(f"t{i}")) for i in (1, 2, 3)]
    t = t.select(*[F.when((d > 0) & (d < i + 1), d).otherwise(F.lit((i + 1) / 2)).alias(f"d{i + 1}")
                   for i, d in enumerate(raw)])
    off = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    grams = level.crossJoin(F.broadcast(t)).select("g", "ctx", "n", off.alias("off"))  # one row of three discounts
    ctx = grams.groupBy("ctx").agg(F.sum("n").alias("total"), (F.sum("off") / F.sum("n")).alias("gamma"))
    alpha = grams.join(ctx, "ctx").select("g", "n", ((F.col("n") - F.col("off")) / F.col("total")).alias("alpha"))
    return alpha, ctx.select("ctx", "gamma")


def model_tables(top: DataFrame) -> dict[int, tuple[DataFrame, DataFrame]]:
    """The class model per order k: :func:`discounted` n-grams and contexts.

    Lower orders count the distinct symbols seen before an n-gram (continuation counts).
    """
    out: dict[int, tuple[DataFrame, DataFrame]] = {}
    level = top
    for k in range(ORDER, 0, -1):
        out[k] = discounted(level.select("g", F.floor(F.col("g") / SYMBOLS).alias("ctx"), "n"))
        level = level.groupBy((F.col("g") % (SYMBOLS ** (k - 1))).alias("g")).agg(F.count(F.lit(1)).alias("n"))
    return out


def dense_log2(tables: dict[int, tuple[DataFrame, DataFrame]]) -> np.ndarray:
    """log2 probability of the last symbol of every n-gram of the highest order (bounded: see above)."""
    p = np.full(1, 1.0 / SYMBOLS)
    for k in range(1, ORDER + 1):
        alpha, gamma = (x.toPandas() for x in tables[k])
        a, w = np.zeros(SYMBOLS ** k), np.ones(SYMBOLS ** (k - 1))
        a[alpha["g"].to_numpy(np.int64)] = alpha["alpha"].to_numpy()
        w[gamma["ctx"].to_numpy(np.int64)] = gamma["gamma"].to_numpy()
        lower = np.tile(p, SYMBOLS) if k > 1 else np.full(SYMBOLS, p[0])
        p = a + np.repeat(w, SYMBOLS) * lower
    return np.log2(p).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> np.ndarray | None:
    """The class model's log2 table over all trusted documents, None if there is no trusted text."""
    ids = counted_broadcast(materialize(trusted_ids(labels), "kn-trusted"))
    texts = docs.select(F.col(f"`{doc_id}`").alias("trusted_id"), F.col(f"`{text}`").alias("text"))
    texts = texts.where("length(text) > 0").join(ids, "trusted_id", "left_semi").select("text")
    counts = materialize(gram_counts(texts), "kn-counts")
    if counts.isEmpty():
        return None
    log2 = dense_log2(model_tables(counts))
    discard(counts)
    return log2


def _mixed(cp: np.ndarray) -> np.ndarray:
    """64 well spread bits per code point (splitmix64), from a table."""
    if not _BITS:
        z = (np.arange(0x110000, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        _BITS.append(z ^ (z >> np.uint64(31)))
    return _BITS[0][cp]


def key_at(z: np.ndarray, ends: np.ndarray, order: int) -> np.ndarray:
    """64-bit keys of the n-grams of ``order`` characters that end at ``ends``; ``z`` are the characters' bits."""
    h = np.zeros(len(ends), dtype=np.uint64)
    for k in range(order):
        h *= FACTOR
        h += z[ends - (order - 1) + k]
    return h


def lower_keys(z: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per n-gram the keys of its context, of the n-gram one shorter, and of that one's context."""
    return key_at(z, ends - 1, DEEP - 1), key_at(z, ends, DEEP - 1), key_at(z, ends - 1, DEEP - 2)


def numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of every key, the distinct keys, their first places)."""
    number, distinct = pd.factorize(keys)
    first = np.empty(len(distinct), dtype=np.int64)
    first[number[::-1]] = np.arange(len(keys) - 1, -1, -1)  # the first place is written last
    return number, distinct, first


class Grams:
    """The distinct n-grams of order DEEP of some texts, with DEEP - 1 spaces before each.

    ``doc`` and ``gram`` give text number and n-gram number of every character, ``keys`` and ``ends`` key and
    first place of every n-gram.
    """

    def __init__(self, texts: list[str]) -> None:
        pad = " " * (DEEP - 1)
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        joined = "".join([pad + t for t in texts])
        self.cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        self.z = _mixed(self.cp)
        self.doc = np.repeat(np.arange(len(texts), dtype=np.int64), sizes)
        ends = np.arange(len(self.doc), dtype=np.int64) + (DEEP - 1) * (self.doc + 1)
        h = np.zeros(max(len(self.z) - DEEP + 1, 0), dtype=np.uint64)
        for k in range(DEEP):
            h *= FACTOR
            h += self.z[k:len(self.z) - (DEEP - 1) + k]
        self.gram, self.keys, first = numbered(h[ends - (DEEP - 1)])
        self.ends = ends[first]

    def characters(self) -> np.ndarray:
        """One row of DEEP code points per n-gram."""
        return self.cp[self.ends[:, None] + np.arange(1 - DEEP, 1)]


def deep_counts(texts: DataFrame) -> DataFrame:
    """(gram, n): counts of the n-grams of order DEEP of a one-column table of texts, summed in the tasks first."""

    def strings(cp: np.ndarray) -> list[str]:
        joined = cp.tobytes().decode("utf-32-le", "surrogatepass")
        return [joined[i:i + DEEP] for i in range(0, len(joined), DEEP)]

    def merged(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys, n, cp = (np.concatenate(x) for x in zip(*held))
        number, keys, at = numbered(keys)
        return keys, np.bincount(number, weights=n).astype(np.int64), cp[at]

    def rows(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        keys, n, cp = merged(held)
        for lo in range(0, len(keys), ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(strings(cp[lo:lo + ROWS]), pa.string()),
                                              pa.array(n[lo:lo + ROWS], pa.int64())], names=["gram", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for lo, hi in _chunks(texts):
                g = Grams(texts[lo:hi])
                held.append((g.keys, np.bincount(g.gram, minlength=len(g.keys)), g.characters()))
                size += len(g.keys)
                del g  # before the next chunk's arrays are built
                if size > HELD:
                    held, size = [merged(held)], 0
                    if len(held[0][0]) > MERGED:
                        yield from rows(held)
                        held = []
        if held:
            yield from rows(held)

    return texts.mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte planes apart, so that their empty planes compress to nothing."""
    return np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked_keys(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Equal ranges of keys."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def discounts(level: DataFrame) -> list[float]:
    """What is taken off counts of 1, 2 and more, by the rule of :func:`discounted`; four numbers reach the driver."""
    t = [0, *level.agg(*[F.count(F.when(F.col("n") == i, 1)) for i in (1, 2, 3, 4)]).first()]
    y = t[1] / (t[1] + 2 * t[2]) if t[1] else None
    raw = [i - (i + 1) * y * t[i + 1] / t[i] if y is not None and t[i] else 0.0 for i in (1, 2, 3)]
    return [d if 0 < d < i else i / 2 for i, d in enumerate(raw, 1)]


def model_rows(level: DataFrame) -> DataFrame:
    """(gram, alpha, gamma, n) of the orders DEEP and DEEP - 1 from a written table (gram, n) of order DEEP: the
    discounted share of an n-gram, the back-off weight of a context, and the (continuation) count of an n-gram; 0, 1
    and 0 where it is not one. Rows of one gram combine to sum, product and sum. Every context is grouped once, with as
    many rows as characters follow it.
    """
    below = materialize(level.groupBy(F.substring("gram", 2, DEEP - 1).alias("gram")).agg(F.count(F.lit(1)).alias("n")),
                        "kn-below")
    out = None
    for k, table in ((DEEP, level), (DEEP - 1, below)):
        d = discounts(table)
        off = F.when(F.col("n") == 1, F.lit(d[0])).when(F.col("n") == 2, F.lit(d[1])).otherwise(F.lit(d[2]))
        contexts = table.select(F.substring("gram", 1, k - 1).alias("ctx"), F.substring("gram", k, 1).alias("c"), "n",
                                off.alias("off")).groupBy("ctx").agg(
            F.sum("n").alias("total"), F.sum("off").alias("off"), F.collect_list(F.struct("c", "n", "off")).alias("next"))
        back = F.struct("ctx", F.lit(0.0).alias("alpha"), (F.col("off") / F.col("total")).alias("gamma"),
                        F.lit(0).cast("long").alias("n"))
        shares = F.transform("next", lambda x: F.struct(
            F.concat("ctx", x["c"]).alias("ctx"), ((x["n"] - x["off"]) / F.col("total")).alias("alpha"),
            F.lit(1.0).alias("gamma"), x["n"].alias("n")))
        rows = contexts.select(F.explode(F.concat(F.array(back), shares)).alias("r")).select(
            F.col("r.ctx").alias("gram"), "r.alpha", "r.gamma", "r.n")
        out = rows if out is None else out.unionByName(rows)
    return out


def keyed(model: DataFrame, buckets: int) -> DataFrame:
    """(bucket, key, alpha, gamma, n) of :func:`model_rows`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = batch.column(0).to_pylist()
            z = _mixed(np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), dtype=np.uint32))
            sizes = np.array([len(g) for g in grams], dtype=np.int64)
            last = np.cumsum(sizes) - 1
            key = np.zeros(len(grams), dtype=np.uint64)
            for order in (DEEP, DEEP - 1, DEEP - 2):
                key[sizes == order] = key_at(z, last[sizes == order], order)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket_of(key, buckets)), pa.array(key.view(np.int64)), *batch.columns[1:]],
                names=["bucket", "key", "alpha", "gamma", "n"])

    return model.select("gram", F.col("alpha").cast("float"), F.col("gamma").cast("float"), "n").mapInArrow(
        run, "bucket long, key long, alpha float, gamma float, n long")


def slices(docs: DataFrame) -> DataFrame:
    """(slice, docs): compressed chunks of documents; up to SLICE_CHARS characters of a task make a slice.
    ``docs``: doc_id, lang, text, trusted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, chars = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for lo, hi in _chunks(texts):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as out:
                    out.write_batch(batch.slice(lo, hi - lo))
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                                                 names=["slice", "docs"])
                chars += sum(len(t or "") for t in texts[lo:hi])
                if chars >= SLICE_CHARS:
                    number, chars = number + 1, 0

    return docs.select("doc_id", "lang", "text", "trusted").mapInArrow(run, "slice long, docs binary")


def wanted_keys(held: DataFrame, buckets: int) -> DataFrame:
    """(slice, bucket, keys): the distinct keys that the n-grams of a slice need, packed per bucket."""

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, cp = (np.concatenate(x) for x in zip(*parts))
        _, keys, at = numbered(keys)
        return keys, cp[at]

    def rows(number: int, parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        keys, cp = merged(parts)
        z, ends = _mixed(cp.ravel()), np.arange(1, len(keys) + 1) * DEEP - 1
        keys = np.unique(np.concatenate([keys, *lower_keys(z, ends)]))
        bucket = bucket_of(keys, buckets)
        at = np.flatnonzero(np.r_[True, np.diff(bucket) != 0]) if len(keys) else np.empty(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), number), pa.int64()), pa.array(bucket[at], pa.int64()),
             pa.array([packed_keys(x) for x in np.split(keys, at[1:])][:len(at)], pa.binary())], names=["slice", "bucket", "keys"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, size = None, [], 0
        for batch in batches:
            for number, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                if parts and number != current:
                    yield rows(current, parts)
                    parts, size = [], 0
                elif size > HELD:
                    parts, size = [merged(parts)], 0
                    if len(parts[0][0]) > MERGED:  # asking for a key twice does no harm
                        yield rows(current, parts)
                        parts = []
                current = number
                for _, g, _ in unpacked(packed.as_buffer()):
                    parts.append((g.keys, g.characters()))
                    size += len(g.keys)
                    del g  # before the next chunk's arrays are built
        if parts:
            yield rows(current, parts)

    return held.mapInArrow(run, "slice long, bucket long, keys binary")


def unpacked(packed: pa.Buffer) -> Iterator[tuple[pa.RecordBatch, Grams, list[str]]]:
    """The documents of a chunk with their n-grams and texts."""
    for batch in pa.ipc.open_stream(packed):
        texts = [t or "" for t in batch.column(2).to_pylist()]
        yield batch, Grams(texts), texts


def looked_up(wanted: pa.Table, model: pa.Table) -> pa.Table:
    """The model's rows of a bucket that each slice wants."""
    keys, at = np.unique(model.column("key").to_numpy().view(np.uint64), return_inverse=True)
    # At most two rows of a key: as an n-gram and as a context.
    alpha, n = (np.bincount(at, weights=model.column(c).to_numpy(), minlength=len(keys)) for c in ("alpha", "n"))
    gamma = np.ones(len(keys))
    np.multiply.at(gamma, at, model.column("gamma").to_numpy().astype(np.float64))
    out: dict[str, list] = {"slice": [], "keys": [], "alpha": [], "gamma": [], "n": []}
    for number, packed in zip(wanted.column("slice").to_pylist(), wanted.column("keys").to_pylist()):
        want = unpacked_keys(packed)
        at = np.minimum(np.searchsorted(keys, want), max(len(keys) - 1, 0))
        at = at[keys[at] == want] if len(keys) else at[:0]
        if len(at):
            out["slice"].append(number)
            out["keys"].append(packed_keys(keys[at]))
            out["alpha"].append(alpha[at].astype(np.float32).tobytes())
            out["gamma"].append(gamma[at].astype(np.float32).tobytes())
            out["n"].append(n[at].astype(np.int64).tobytes())
    return pa.table(out, schema=pa.schema([("slice", pa.int64())] + [(c, pa.binary()) for c in ("keys", "alpha", "gamma", "n")]))


class Model:
    """The rows of the model that a slice wanted; what is not there was never seen in trusted text."""

    def __init__(self, found: pa.Table) -> None:
        def column(name: str, kind: type) -> np.ndarray:
            return np.frombuffer(b"".join(found.column(name).to_pylist()), dtype=kind)

        every = [unpacked_keys(x) for x in found.column("keys").to_pylist()]
        keys, at = np.unique(np.concatenate([np.empty(0, np.uint64), *every]), return_index=True)
        self.index = pd.Index(keys)
        # One more entry, reached by the index -1 of a missing key.
        self.alpha = np.append(column("alpha", np.float32)[at], np.float32(0)).astype(np.float64)
        self.gamma = np.append(column("gamma", np.float32)[at], np.float32(1)).astype(np.float64)
        self.n = np.append(column("n", np.int64)[at], 0)

    def shares(self, g: Grams, log2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(n, alpha, gamma, lower, only) per n-gram: the last character's probability is alpha + gamma * lower.

        ``n`` is the count in trusted text, ``only`` is ``lower`` for a document that alone holds the n-gram.
        """
        top, (ctx, low, low_ctx) = self.index.get_indexer(g.keys), (self.index.get_indexer(k) for k in lower_keys(g.z, g.ends))
        symbol = _symbol_table()[g.characters()[:, DEEP - ORDER:]]
        ids = np.zeros(len(symbol), dtype=np.int64)
        for k in range(ORDER):
            ids = ids * SYMBOLS + symbol[:, k]
        size = np.bincount(_symbol_table(), minlength=SYMBOLS)
        rest = self.gamma[low_ctx] * np.exp2(log2[ids].astype(np.float64)) / size[symbol[:, -1]]
        lower = self.alpha[low] + rest
        return self.n[top], self.alpha[top], self.gamma[ctx], lower, np.where(self.n[low] == 1, rest, lower)


def chunk_bits(batch: pa.RecordBatch, g: Grams, texts: list[str], model: Model, log2: np.ndarray) -> np.ndarray:
    """Bits of every document of a chunk; a trusted one is scored without its own n-grams."""
    n, alpha, gamma, lower, only = model.shares(g, log2)
    plain = -np.log2(alpha + gamma * lower)
    bits = np.bincount(g.doc, weights=plain[g.gram], minlength=len(texts))
    trusted = np.array(batch.column(3).to_pylist(), dtype=bool)
    mine = trusted[g.doc]
    pairs, own = np.unique(g.gram[mine] * len(texts) + g.doc[mine], return_counts=True)
    gram, doc = pairs // len(texts), pairs % len(texts)
    p = alpha[gram] * (1 - own / np.maximum(n[gram], 1)) + gamma[gram] * np.where(own == n[gram], only[gram], lower[gram])
    return np.where(trusted, np.bincount(doc, weights=-own * np.log2(p), minlength=len(texts)), bits)


def perplexities(docs: DataFrame, labels: DataFrame, log2: np.ndarray, text: str = "text", doc_id: str = "doc_id",
                 lang: str = "lang") -> DataFrame:
    """(doc_id, lang, n_chars, trusted, log2_ppl): mean negative log2 probability per character (trusted: leave one out),
    as written tables."""
    spark = docs.sparkSession
    ids = counted_broadcast(materialize(trusted_ids(labels).withColumn("trusted", F.lit(True)), "kn-trusted"))
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
                       F.col(f"`{text}`").cast("string").alias("text"))
    rows = rows.join(ids, F.col("doc_id") == F.col("trusted_id"), "left").withColumn(
        "trusted", F.coalesce("trusted", F.lit(False)))
    level = materialize(deep_counts(rows.where("trusted AND length(text) > 0").select("text")), "kn-grams")
    # A bucket's model rows and the keys wanted from it stay bounded: their number grows with model and text.
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(64, level.count() // BUCKET_ROWS, chars // BUCKET_CHARS)
    discard()
    model = materialize(keyed(model_rows(level), buckets), "kn-model")
    discard(level)
    shared = spark.sparkContext.broadcast(log2)
    passes = min(PASSES, max(1, chars // PASS_CHARS))
    # A task reads as much of a pass as it would of the whole table, so a slice asks for a shared key once.
    tasks = max(spark.sparkContext.defaultParallelism, chars // passes // TASK_CHARS)

    def scored(chunks: pa.Table, shares: pa.Table) -> pa.Table:
        rows_of = Model(shares)
        out = []
        for packed in chunks.column("docs"):
            for batch, g, texts in unpacked(packed.as_buffer()):
                n = np.array([len(t) for t in texts], dtype=np.int64)
                bits = chunk_bits(batch, g, texts, rows_of, shared.value) / np.maximum(n, 1)
                out.append(pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(n), batch.column(3), pa.array(bits, mask=n == 0)], schema=kept))
        return pa.Table.from_batches(out, schema=kept)

    kept = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("n_chars", pa.int64()), ("trusted", pa.bool_()),
                      ("log2_ppl", pa.float64())])
    out = None
    for i in range(passes):
        some = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(passes)) == i).coalesce(tasks)
        # Read twice (keys out, shares back): one exchange, which the plan reuses.
        held = slices(some).repartition(shuffle_partitions(spark), "slice")
        found = wanted_keys(held, buckets).groupBy("bucket").cogroup(model.groupBy("bucket")).applyInArrow(
            looked_up, "slice long, keys binary, alpha binary, gamma binary, n binary")
        part = materialize(held.groupBy("slice").cogroup(found.groupBy("slice")).applyInArrow(
            scored, "doc_id long, lang string, n_chars long, trusted boolean, log2_ppl double"), "kn-scores")
        out = part if out is None else out.unionByName(part)
        del some, held, found
        discard()
    discard(model)
    return out


def thresholds(scored: DataFrame, quantile: float) -> DataFrame:
    """(lang, top): the quantile's step among the trusted documents of each language, and of all (lang null).

    Counted in steps of 1/STEPS, so the windows run over one row per language and step.
    """
    steps = scored.where("trusted AND log2_ppl IS NOT NULL").groupBy(
        "lang", F.floor(F.col("log2_ppl") * STEPS).alias("step")).count()
    both = steps.unionByName(steps.groupBy("step").agg(F.sum("count").alias("count"))
                             .select(F.lit(None).cast("string").alias("lang"), "step", "count"))
    w = Window.partitionBy("lang")
    seen = both.withColumn("upto", F.sum("count").over(w.orderBy("step"))).withColumn("total", F.sum("count").over(w))
    return (seen.where(F.col("upto") >= quantile * F.col("total")).groupBy("lang")
            .agg(((F.min("step") + 1) / STEPS).alias("top")))


def classify(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang",
             quantile: float = QUANTILE) -> DataFrame:
    """(doc_id, lang, n_chars, perplexity, threshold, trusted, kept) for every document."""
    require(docs, text, doc_id, lang)
    require(labels, "doc_id", "quality", "toxic")
    log2 = train(docs, labels, text, doc_id)
    if log2 is None:
        none = F.lit(None).cast("double")
        n = F.length(F.coalesce(F.col(f"`{text}`"), F.lit(""))).cast("long")
        return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                           F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), n.alias("n_chars"),
                           none.alias("perplexity"), none.alias("threshold"), F.lit(False).alias("trusted"),
                           (n > 0).alias("kept"))
    scored = perplexities(docs, labels, log2, text, doc_id, lang)
    limits = materialize(thresholds(scored, quantile), "kn-limits")  # one row per language
    per_lang = limits.where("lang IS NOT NULL")
    overall = limits.where("lang IS NULL").select(F.col("top").alias("overall"))
    out = scored.join(counted_broadcast(per_lang), "lang", "left").join(F.broadcast(overall), how="left")
    top = F.coalesce("top", "overall")
    return out.select("doc_id", "lang", "n_chars", F.pow(F.lit(2.0), F.col("log2_ppl")).alias("perplexity"),
                      F.pow(F.lit(2.0), top).alias("threshold"), "trusted",
                      F.coalesce(F.col("log2_ppl") <= top, F.lit(False)).alias("kept"))
