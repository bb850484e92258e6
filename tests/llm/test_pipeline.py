"""The pipeline against a plain Python version of its stages, on a small corpus."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from ledgerline.llm import op2_line_dedup, op6_language
from ledgerline.llm.common import materialize

from .test_native import brute_lines
from .test_python_ops import check_packing
from .test_simhash import brute_components, plain_simhash

SF = "/root/testdata/sf0.001"


def plain_languages(docs):
    """Language and cosine of every text, from dictionaries of trigrams."""
    p2, p1, p0 = (v.astype(np.int64) for v in op6_language._vectors(op6_language.DIMS, op6_language.SEED))

    def bundle(text):
        t = re.sub(r" +", " ", "".join(c if c.isalpha() else " " for c in f" {(text or '').lower()} "))
        rows = [0 if c == " " else 1 + ord(c) % (op6_language.LETTERS - 1) for c in t]
        grams = Counter(g for g in zip(rows, rows[1:], rows[2:]) if any(g))
        return sum((n * p2[a] * p1[b] * p0[c] for (a, b, c), n in grams.items()), np.zeros(op6_language.DIMS, np.int64))

    vectors = {i: bundle(t) for i, t, _ in docs}
    proto = {}
    for i, t, lang in docs:
        if lang is not None and zlib.crc32(str(i).encode()) % 3 != 1:
            proto[lang] = proto.get(lang, 0) + vectors[i]
    out = {}
    for i, v in vectors.items():
        cos = {k: v @ p / max(1, np.linalg.norm(v)) / np.linalg.norm(p) for k, p in sorted(proto.items())}
        best = max(cos, key=lambda k: cos[k])
        out[i] = (best, max(0.0, cos[best])) if v.any() else ("und", 0.0)
    return out


def shingles(text):
    w = [x for x in re.split(r"[^\w]|_", (text or "").lower()) if x]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    r = random.Random(11)
    rows = [tuple(x) for x in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()]
    bench = [x["text"] for x in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows += [(1000, None, "en"), (1001, "", None), (1002, "12 34 !!", "en")]
    rows += [(1100 + i, rows[i][1], rows[i][2]) for i in range(20)]  # copies
    rows += [(1200 + i, rows[30 + i][1] + " " + bench[i], rows[30 + i][2]) for i in range(10)]  # leaks
    r.shuffle(rows)
    folder = tmp_path_factory.mktemp("corpus")
    df = spark.createDataFrame([(i, t, g, "s", len(t or ""), "x") for i, t, g in rows],
                               "doc_id long, text string, lang string, source string, n_chars long, score string")
    df.write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), rows, bench


def test_stages_against_plain_python(spark, corpus):
    folder, rows, bench = corpus
    texts = {i: t for i, t, _ in rows}
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert [k for k, _ in corpus_pipeline.STAGES] == [
        "language ID", "line dedup", "SimHash near-dedup", "benchmark decontamination", "packing"]

    lang = plain_languages(rows)
    texts = {i: t for i, t in texts.items() if lang[i][0] != "und" and lang[i][1] >= corpus_pipeline.MIN_SCORE}
    docs = materialize(stages["language ID"](spark, docs, folder), "t")
    assert docs.columns == columns and {r["doc_id"]: r["text"] for r in docs.collect()} == texts
    assert {r["score"] for r in docs.collect()} == {"x"}

    lines = brute_lines(list(texts.items()), op2_line_dedup.WINDOW)
    texts = {i: t for i, (n, gone, t) in lines.items() if not gone or gone < n}
    docs = materialize(stages["line dedup"](spark, docs, folder), "t")
    got = docs.collect()
    assert docs.columns == columns and {r["doc_id"]: r["text"] for r in got} == texts
    assert all(r["n_chars"] == len(r["text"]) for r in got)

    ids = sorted(texts)
    comp = brute_components([plain_simhash(texts[i]) for i in ids], 4)
    texts = {i: texts[i] for k, i in enumerate(ids) if comp[k] == k}
    docs = materialize(stages["SimHash near-dedup"](spark, docs, folder), "t")
    assert docs.columns == columns and {r["doc_id"]: r["text"] for r in docs.collect()} == texts

    items = [s for s in map(shingles, bench) if s]
    texts = {i: t for i, t in texts.items() if not any(len(s & shingles(t)) >= 0.8 * len(s) for s in items)}
    docs = materialize(stages["benchmark decontamination"](spark, docs, folder), "t")
    assert docs.columns == columns and {r["doc_id"]: r["text"] for r in docs.collect()} == texts
    assert len(texts) < len(ids)

    pieces = stages["packing"](spark, docs, folder).collect()
    check_packing(pieces, texts)
    assert {r["doc_id"] for r in pieces} == set(texts)
    whole = corpus_pipeline.run(spark, folder).groupBy("doc_id").agg({"length": "sum"}).collect()
    sums = Counter()
    for r in pieces:
        sums[r["doc_id"]] += r["length"]
    assert {r["doc_id"]: r["sum(length)"] for r in whole} == dict(sums)


def test_empty_corpus(spark, corpus):
    folder, _, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, folder), "t")
        assert docs.count() == 0
