"""Language identification with hyperdimensional letter n-gram profiles.

Method: every letter has a random +1/-1 vector. A letter trigram is the element-wise product
(binding) of its letters' vectors, rotated by two, one and zero places (permutation), so order
matters; a text is the sum (bundle) of its trigrams, a language prototype the sum of the texts
labelled with it; a text gets the language whose prototype has the largest cosine.

Training sums are integers, so they do not depend on how rows are dealt out. What reaches the
driver is one vector per distinct label (``DIMS`` longs), never anything per document.

Text is lower-cased; anything but a letter counts as a space, runs of spaces as one, and a
space is put before and after the text, so a single letter already makes a trigram.

Defined results: null text or text without a letter: ``und`` with score 0; no labelled row to
learn from: ``und`` with score 0 for all; equal cosines: the smaller label; a null id counts as
not held out; repeated rows each get the same result; an input column named like an output
column is replaced; other columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import require

UND = "und"
DIMS = 512
SEED = 42
#: Letters beyond this many share vectors (code point modulo the table size).
LETTERS = 4096
#: Documents handled together; texts longer than SLICE_CHARS in sum start a new slice.
SLICE_DOCS, SLICE_CHARS = 128, 400_000

_STATE: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
_LETTER: list[np.ndarray] = []


def _vectors(dims: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letter vectors rotated by 2, 1 and 0 places; row 0 stands for the space."""
    if (dims, seed) not in _STATE:
        v = np.random.default_rng(seed).integers(0, 2, (LETTERS, dims), dtype=np.int8) * 2 - 1
        _STATE[dims, seed] = (np.roll(v, 2, axis=1), np.roll(v, 1, axis=1), v)
    return _STATE[dims, seed]


def _letter_table() -> np.ndarray:
    """Code point -> row of the letter table, 0 for anything that is not a letter."""
    if not _LETTER:
        ok = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
        rows = 1 + np.arange(0x110000) % (LETTERS - 1)
        _LETTER.append(np.where(ok, rows, 0).astype(np.int16))
    return _LETTER[0]


def trigram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, trigram, count) of all texts; a trigram is three letter rows in base LETTERS."""
    joined = "\n".join([" " + t.lower() + " " for t in texts])
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    sizes = np.array([len(t.lower()) + 3 for t in texts])  # two spaces and the separator
    doc = np.repeat(np.arange(len(texts)), sizes)[:len(cp)]
    row = _letter_table()[cp].astype(np.int64)
    keep = np.ones(len(row), dtype=bool)
    keep[1:] = (row[1:] != 0) | (row[:-1] != 0) | (doc[1:] != doc[:-1])
    row, doc = row[keep], doc[keep]
    if len(row) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    key = (row[:-2] * LETTERS + row[1:-1]) * LETTERS + row[2:]
    inside = (doc[:-2] == doc[2:]) & ((row[:-2] | row[1:-1] | row[2:]) != 0)
    packed, n = np.unique((doc[:-2][inside] << 36) | key[inside], return_counts=True)
    return packed >> 36, packed & ((1 << 36) - 1), n


def bundles(doc: np.ndarray, tri: np.ndarray, n: np.ndarray, n_docs: int, dims: int, seed: int) -> np.ndarray:
    """One bundled vector per text: counts times bound trigram vectors."""
    p2, p1, p0 = _vectors(dims, seed)
    grams, at = np.unique(tri, return_inverse=True)
    out = np.zeros((n_docs, dims), dtype=np.float32)
    for lo in range(0, len(grams), 8192):
        g = grams[lo:lo + 8192]
        v = p2[g // (LETTERS * LETTERS)] * p1[g // LETTERS % LETTERS] * p0[g % LETTERS]
        here = (at >= lo) & (at < lo + len(g))
        counts = np.zeros((n_docs, len(g)), dtype=np.float32)
        counts[doc[here], at[here] - lo] = n[here]
        out += counts @ v.astype(np.float32)
    return out


def _slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    lo = chars = 0
    for i, t in enumerate(texts):
        if i > lo and (i - lo >= SLICE_DOCS or chars + len(t or "") > SLICE_CHARS):
            yield lo, i
            lo, chars = i, 0
        chars += len(t or "")
    if texts:
        yield lo, len(texts)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", dims: int = DIMS, seed: int = SEED) -> dict[str, list[int]]:
    """Prototype per distinct non-null label: the integer sum of its texts' bundles."""
    require(docs, text, lang)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in _slices(texts):
                names = sorted(set(langs[lo:hi]))
                place = {name: i for i, name in enumerate(names)}
                doc, tri, n = trigram_counts([t or "" for t in texts[lo:hi]])
                label = np.array([place[x] for x in langs[lo:hi]])[doc] if len(doc) else doc
                # Texts of one label are bundled together.
                packed, at = np.unique((label << 36) | tri, return_inverse=True)
                sums = np.bincount(at, weights=n, minlength=len(packed)) if len(packed) else np.empty(0)
                got = bundles(packed >> 36, packed & ((1 << 36) - 1), sums, len(names), dims, seed)
                for name, row in zip(names, got):
                    total[name] = total.get(name, 0) + np.rint(row).astype(np.int64)
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array([v.tolist() for v in total.values()], pa.list_(pa.int64()))],
                names=["lang", "v"])

    rows = docs.where(F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").isNotNull()).select(
        F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("string").alias("text"))
    parts = rows.mapInArrow(run, "lang string, v array<long>")
    sums = parts.select("lang", F.posexplode("v").alias("dim", "x")).groupBy("lang", "dim").agg(F.sum("x").alias("x"))
    out: dict[str, list[int]] = {}
    for r in sums.collect():  # one row per label and dimension
        out.setdefault(r["lang"], [0] * dims)[r["dim"]] = r["x"]
    return {k: v for k, v in sorted(out.items()) if any(v)}


def predict(docs: DataFrame, prototypes: dict[str, list[int]], text: str = "text", dims: int = DIMS,
            seed: int = SEED) -> DataFrame:
    """All input columns plus ``lang_pred`` and ``score`` (the cosine, negative ones as 0)."""
    require(docs, text)
    labels = sorted(prototypes)
    proto = np.array([prototypes[x] for x in labels], dtype=np.float64).reshape(len(labels), dims)
    norms = np.linalg.norm(proto, axis=1)
    unit = (proto / np.where(norms > 0, norms, 1)[:, None]).astype(np.float32)
    rest = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")])
    schema = T.StructType([*rest.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    where = rest.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(where).to_pylist()
            pred, score = [], []
            for lo, hi in _slices(texts):
                doc, tri, n = trigram_counts([t or "" for t in texts[lo:hi]])
                found = np.bincount(doc, minlength=hi - lo) > 0
                if not labels:
                    pred += [UND] * (hi - lo)
                    score += [0.0] * (hi - lo)
                    continue
                v = bundles(doc, tri, n, hi - lo, dims, seed)
                size = np.linalg.norm(v, axis=1)
                cos = (v @ unit.T) / np.where(size > 0, size, 1)[:, None]
                best = cos.argmax(axis=1)
                pred += [labels[b] if ok else UND for b, ok in zip(best, found)]
                top = np.clip(cos[np.arange(hi - lo), best].astype(np.float64), 0.0, 1.0)
                score += np.where(found, top, 0.0).tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"])

    return rest.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """The held-out third: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learn from the rows that are not held out, predict all; input columns, ``held_out``, ``lang_pred``, ``score``."""
    out = held_out(F.col(f"`{doc_id}`"))
    prototypes = fit(docs.where(~out), text, lang)
    return predict(docs.withColumn("held_out", out), prototypes, text)
