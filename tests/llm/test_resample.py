"""Importance resampling against a plain Python version."""

import hashlib
import math
import random
import re
import zlib

import pytest

import __spark_entry__ as E
from ledgerline.llm import op12_resample as op
from ledgerline.llm.common import materialize

SF = "/root/testdata/sf0.001"
FOLD = {c: c + 32 for c in range(65, 91)}


def features(text):
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(FOLD))
    return [" ".join(w[i:i + g]) for g in (1, 2, 3) for i in range(len(w) - g + 1)], len(w)


def brute(docs, target):
    def count(texts):
        out = [0] * 10_000
        for t in texts:
            for f in features(t)[0]:
                out[zlib.crc32(f.encode()) % 10_000] += 1
        return out

    s, t = count([x for _, x in docs]), count(target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + 10_000) / ((a + 1) * (sum(t) + 10_000)))) for a, b in zip(s, t)]
    rows = []
    for i, x in docs:
        f, n = features(x)
        w = sum(gain[zlib.crc32(y.encode()) % 10_000] for y in f)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + .5) / 4294967296))), n])
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    for r in rows:
        r.append(None)
    for k, r in enumerate(able[:5 * len(able) // 100]):
        r[5] = k + 1
    return sorted(((r[0], r[1], r[2], r[3], r[5]) for r in rows), key=str)


def rows(df):
    return sorted(((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in df.collect()), key=str)


def test_whole_tables(spark, documents):
    docs = [(r["doc_id"], r["text"]) for r in documents.collect()]
    target = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = rows(E.queries()["op12_importance_resampling"](spark, SF))
    assert got == brute(docs, target)
    assert sum(r[4] is not None for r in got) > 3


def test_ties_repeats_and_odd_rows(spark, odd):
    rng = random.Random(4)
    docs = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    docs += [(rng.randint(0, 90), " ".join(rng.choice(["alpha", "Beta", "gamma7", "É"]) for _ in range(rng.randint(15, 40))))
             for _ in range(150)]
    docs += [docs[20]] * 30
    target = ["alpha beta beta", None, ""]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    aim = spark.createDataFrame([(x,) for x in target], "text string")
    assert rows(op.resample(frame, aim)) == brute(docs, target)
    assert rows(op.resample(odd, aim.limit(0))) == brute([(r["doc_id"], r["text"]) for r in odd.collect()], [])
    assert op.resample(odd.limit(0), aim).count() == 0


@pytest.mark.parametrize("pivots", [1, 3, 24])
def test_quickselect(spark, pivots):
    rng = random.Random(pivots)
    keys = [(rng.randint(-3, 3), rng.choice([None, 1, 2]), i) for i in range(200)]
    table = materialize(spark.createDataFrame(keys, "a long, b long, c long"), "keys")
    want = sorted(keys, key=lambda x: (x[0], -1 if x[1] is None else x[1], x[2]))
    for k in (1, 2, 100, 199, 200):
        assert op.kth_key(table, k, pivots) == want[k - 1]
    assert op.kth_key(table, 0) is None


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = " ".join(f"w{i % 31}" for i in range(500)).encode()
    whole = sorted(x for part in op.feature_buckets(text) for x in part.tolist())
    monkeypatch.setattr(op, "_STEP", 7)
    assert sorted(x for part in op.feature_buckets(text) for x in part.tolist()) == whole
    assert len(whole) == 500 + 499 + 498
