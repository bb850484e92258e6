"""Source divergence: against DuckDB on whole tables and a plain Python version on odd rows."""

import re
from collections import Counter, defaultdict

import pytest

from ledgerline.llm import op13_divergence as op
from ledgerline.llm.common import materialize

from .test_native import test_oracle as _oracle

FOLD = {c: c + 32 for c in range(65, 91)}


def brute(docs, least=10, top=10):
    counts, inside = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in docs:
        w = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(FOLD))
        counts[lang or "", source or ""].update(w)
        inside[lang or ""].update(set(w))
    out = []
    for lang in {g[0] for g in counts}:
        kept = [t for t, n in inside[lang].items() if n >= least]
        groups = {s: c for (g, s), c in counts.items() if g == lang}
        everything = Counter()
        for c in groups.values():
            everything.update(c)

        def p(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        of, whole = {s: p(c) for s, c in groups.items()}, p(everything)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in groups:
            pairs = [(o, sum(f(of[s][t], of[o][t]) for t in kept)) for o in groups if o != s]
            terms = [(t, f(of[s][t], whole[t])) for t in kept if groups[s][t] and of[s][t] > whole[t]]
            for part, items, n in (("pair", pairs, None), ("term", terms, top)):
                items = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:n]
                out += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(items)]
    return sorted(out)


def rows(df):
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in df.collect())


def test_whole_tables(spark):
    _oracle(spark, "op13_source_divergence")


@pytest.mark.parametrize("least", [1, 2, 10])
def test_odd_rows(spark, odd, monkeypatch, least):
    # Small shards and few cells at a time: sums over shards and stretches.
    monkeypatch.setattr(op, "CELLS", 40)
    docs = [(r["lang"], r["source"], r["text"]) for r in odd.select("lang", "source", "text").collect()]
    more = [("en", f"s{i % 7}", " ".join(f"T{'abcdefghij'[(i * j) % 10]}é{'xyz'[j % 3]} don't" for j in range(i % 30))) for i in range(90)]
    more += [("fr", None, "")] * 3 + [("fr", "only", "un deux"), (None, "x", "un deux")]
    frame = odd.select("lang", "source", "text").unionByName(spark.createDataFrame(more, "lang string, source string, text string"))
    assert rows(op.divergence(frame, min_documents=least)) == brute(docs + more, least)


def test_shards_add_up(spark, documents):
    rows_ = documents.selectExpr("coalesce(lang, '') AS lang", "coalesce(source, '') AS source", "coalesce(text, '') AS text")
    counts = op.kept_counts(rows_, 2)
    groups = op.group_sizes(counts)
    one = op.pair_values(counts, groups, 10**9).collect()
    assert sorted(map(tuple, op.pair_values(counts, groups, 50).collect())) == sorted(map(tuple, one))
    shards = materialize(counts.where("term <> ''").groupBy("lang").count().selectExpr("lang", "1L AS shards"), "one")
    levels = op.level_bitmaps(counts, shards)
    # Every bitset holds as many ids as its level has terms.
    wrong = levels.where("level <> aggregate(bits, 0L, (a, b) -> a + bit_count(b))").count()
    assert wrong == 0 and levels.count() > 0


def test_empty(spark, odd):
    assert op.divergence(odd.limit(0)).count() == 0
