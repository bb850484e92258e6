"""Operators without SQL: brute force, round trips and held-out accuracy."""

import hashlib
import re
import struct
import zlib
from collections import defaultdict

import pytest

from ledgerline.llm import op1_kneser_ney, op3_html, op5_packing, op6_language, op8_sharding, op9_substring

SF = "/root/testdata/sf0.001"


def test_quality_keeps_clean_and_drops_junk(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = op1_kneser_ney.classify(documents, labels)
    rows = {r["doc_id"]: r for r in got.join(labels, "doc_id").collect()}
    good = [r["kept"] for r in rows.values() if r["quality"] == 1 and r["toxic"] == 0]
    bad = [r["kept"] for r in rows.values() if r["quality"] == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.5 * len(bad)


def test_kneser_ney_sums_to_one(spark):
    texts = spark.createDataFrame([("the cat sat on the mat.",), ("a dog sat.\nthe end",), ("aaaa aaab",)], "text string")
    log2 = op1_kneser_ney.dense_log2(op1_kneser_ney.model_tables(op1_kneser_ney.gram_counts(texts)))
    sums = (2.0 ** log2.astype(float)).reshape(-1, op1_kneser_ney.SYMBOLS).sum(axis=1)
    assert abs(sums - 1).max() < 1e-3


def test_quality_model_tells_characters_of_a_class_apart(spark):
    """Characters 14 code points apart share a class; the model knows them by themselves."""
    seen, other = "абвгд вгдаб дабвг " * 30, "".join(chr(ord(c) + 14) if c != " " else c for c in "абвгд вгдаб дабвг " * 30)
    docs = spark.createDataFrame([(1, seen, "ru"), (2, seen, "ru"), (3, other, "ru")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in op1_kneser_ney.classify(docs, labels).collect()}
    assert got[1]["perplexity"] == got[2]["perplexity"] and got[1]["kept"] and got[2]["kept"]
    assert got[3]["perplexity"] > 10 * got[1]["perplexity"] and not got[3]["kept"]


def plain_shares(texts):
    """(gram -> count, gram -> count of lower order, share(gram, class probability)) in plain Python."""
    top, low = defaultdict(int), defaultdict(int)
    for t in texts:
        p = " " * 5 + t
        for i in range(len(t)):
            top[p[i:i + 6]] += 1
    for g in top:
        low[g[1:]] += 1

    def level(counts):
        of = [sum(1 for n in counts.values() if n == i) for i in range(5)]
        y = of[1] / (of[1] + 2 * of[2]) if of[1] else None
        off = []
        for i in (1, 2, 3):
            d = i - (i + 1) * y * of[i + 1] / of[i] if of[i] and y is not None else -1
            off.append(d if 0 < d < i else i / 2)
        total, back = defaultdict(int), defaultdict(float)
        for g, n in counts.items():
            total[g[:-1]] += n
            back[g[:-1]] += off[min(n, 3) - 1]
        alpha = {g: (n - off[min(n, 3) - 1]) / total[g[:-1]] for g, n in counts.items()}
        return alpha, {c: back[c] / total[c] for c in total}

    (a6, w6), (a5, w5) = level(top), level(low)

    def share(g, p, own=0):
        rest = w5.get(g[1:-1], 1.0) * p
        lower = a5.get(g[1:], 0.0) + rest
        if own and own == top[g]:
            lower = rest if low[g[1:]] == 1 else lower
        return a6.get(g, 0.0) * (1 - own / max(top.get(g, 0), 1)) + w6.get(g[:-1], 1.0) * lower

    return share


def class_probability(log2, g):
    table, size = op1_kneser_ney._symbol_table(), op1_kneser_ney.SYMBOLS
    at = 0
    for ch in g[-op1_kneser_ney.ORDER:]:
        at = at * size + int(table[ord(ch)])
    return 2.0 ** float(log2[at]) / int((table == table[ord(g[-1])]).sum())


def test_kneser_ney_against_plain_python(spark):
    """Perplexities by joins of packed keys, with leave-one-out, equal those of dictionaries."""
    import math
    import random
    r = random.Random(3)
    texts = ["".join(r.choice("ab cé\n") for _ in range(r.randint(1, 60))) for _ in range(40)] + ["a", "жук " * 9, "", None, "x"]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 41, 2)], "doc_id long, quality int, toxic int")
    log2 = op1_kneser_ney.train(docs, labels)
    trusted = [texts[i] for i in range(0, 41, 2)]
    share = plain_shares(trusted)
    want = {}
    for i, t in enumerate(texts):
        p = " " * 5 + (t or "")
        grams = [p[k:k + 6] for k in range(len(t or ""))]
        mine = i < 41 and i % 2 == 0
        bits = [-math.log2(share(g, class_probability(log2, g), grams.count(g) if mine else 0)) for g in grams]
        want[i] = sum(bits) / len(bits) if bits else None
    got = {x["doc_id"]: x["log2_ppl"] for x in op1_kneser_ney.perplexities(docs, labels, log2).collect()}
    assert got.keys() == want.keys()
    bad = {i: (got[i], want[i]) for i in want if (got[i] is None) != (want[i] is None) or (want[i] and abs(got[i] - want[i]) > 1e-5)}
    assert not bad
    every = [chr(x) for x in range(0x110000) if not 0xD800 <= x < 0xE000]
    row = class_row(log2, "cb ", every)
    assert abs(sum(share("a cb " + ch, row[ch]) for ch in every) - 1) < 0.01


def class_row(log2, before, characters):
    table, size = op1_kneser_ney._symbol_table(), op1_kneser_ney.SYMBOLS
    at = 0
    for ch in before:
        at = at * size + int(table[ord(ch)])
    held = [int((table == k).sum()) for k in range(size)]
    return {ch: 2.0 ** float(log2[at * size + table[ord(ch)]]) / held[table[ord(ch)]] for ch in characters}


def test_kneser_ney_chunks(spark):
    """Small batches give many chunks and the same figures."""
    docs = spark.createDataFrame([(i, f"text number {i % 7} of the lot " * (1 + i % 5), "en") for i in range(60)],
                                 "doc_id long, text string, lang string").coalesce(1)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 60, 3)], "doc_id long, quality int, toxic int")
    log2 = op1_kneser_ney.train(docs, labels)

    def rows():
        return sorted((x["doc_id"], round(x["log2_ppl"], 6)) for x in op1_kneser_ney.perplexities(docs, labels, log2).collect())

    one = rows()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert rows() == one and len(one) == 60
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_quality_odd_rows(spark, odd):
    labels = spark.createDataFrame([(6, 1, 0), (9, 1, None), (9, 1, 1), (None, 1, 0), (5, None, 0)],
                                   "doc_id long, quality int, toxic int")
    for lab in (labels, labels.limit(0)):
        got = op1_kneser_ney.classify(odd, lab).collect()
        assert len(got) == odd.count()
        assert all(not r["kept"] for r in got if r["n_chars"] == 0)
    assert op1_kneser_ney.classify(odd.limit(0), labels).count() == 0


PAGE = ("<html><head><title>t</title><style>p{}</style></head><body><div class='top-menu'>Menu</div><div>Site notice line {host}</div>"
        "<article><header><h1>Head &amp; line</h1></header><p>One  two<br>three<p>Four &eacute; &lt;b&gt;<ul><li>x<li>y</ul>"
        "<div class=ad>Buy</div><section id='comments'><p>Nice!</p></section><script>var a='<p>no</p>'</script></article>"
        "<footer>foot</footer></body></html>")


def test_html_article():
    assert op3_html.Page(PAGE).text(set()) == "Head & line\nOne two three\nFour é <b>\nx\ny"
    assert op3_html.Page("").text(set()) == "" and op3_html.Page("<div class=nav>x").text(set()) == ""
    assert op3_html.Page("a < b <i>c</i> &am d<!-- x").text(set()) == "a < b c &am d"
    assert op3_html.Page("<div class='ad'>buy<article><p>text</article>").text(set()) == "text"


@pytest.mark.parametrize("send_rows", [1000, 0])
def test_html_templates_per_host(spark, send_rows):
    page = "<body><div><p>All rights reserved by us</p></div><div><p>Story {i}</p></div></body>"
    rows = [(i, f"http://a.example/{i}", page.format(i=i)) for i in range(6)]
    rows += [(10, "http://b.example/1", page.format(i=10)), (11, None, None), (None, "odd", "<p>x"), (None, "odd", "<p>x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = op3_html.main_text(pages, send_rows=send_rows).collect()
    by = {r["page_id"]: r["text"] for r in got}
    assert all(by[i] == f"Story {i}" for i in range(6))
    assert by[10] == "All rights reserved by us\nStory 10" and by[11] == "" and by[None] == "x" and len(got) == 10
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert op3_html.main_text(pages.limit(0), send_rows=send_rows).count() == 0


def test_html_copies_are_no_templates_and_hosts_may_be_large(spark):
    article = "<body><article><h1>Head</h1><ul><li>one<li>two</ul></article></body>"
    rows = [(i, f"http://a.example/{i}", article) for i in range(4)]
    page = "<body><div><p>{t}</p></div><div><p>Story {i}</p></div></body>"
    rows += [(100 + i, f"http://b.example/{i}", page.format(t="Rights reserved" if i < 5 else f"Text {i}", i=i)) for i in range(80)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in op3_html.main_text(pages).collect()}
    assert all(got[i] == "Head\none\ntwo" for i in range(4))
    assert all(got[100 + i] == (f"Story {i}" if i < 5 else f"Text {i}\nStory {i}") for i in range(80))


def test_html_pages_are_their_articles(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in op3_html.main_text(pages).collect()}
    from html import unescape
    for r in pages.collect():
        body = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        assert got[r["page_id"]] == "\n".join(b for b in blocks if b)


def check_packing(rows, texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(op5_packing.default_tokenizer())
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_seq[r["sequence_id"]].append(r)
        by_doc[r["doc_id"]].append(r)
    for rs in by_seq.values():
        at = 0
        for r in sorted(rs, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= op5_packing.SEQ_LEN
    for i, text in texts.items():
        ids = tok.encode(text or "", add_special_tokens=False).ids + [op5_packing.CLOSING_ID]
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            piece = ids[at:at + r["length"]]
            assert zlib.crc32(struct.pack(f"<{len(piece)}I", *piece)) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
    return len(by_seq)


def test_packing_round_trip(spark, documents):
    texts = {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}
    rows = op5_packing.pack(documents, group_docs=64).collect()
    n = check_packing(rows, texts)
    assert n <= sum(r["length"] for r in rows) / op5_packing.SEQ_LEN + 5


def test_packing_odd_rows(spark, odd):
    rows = op5_packing.pack(odd).collect()
    by = defaultdict(int)
    for r in rows:
        by[r["doc_id"]] += r["length"]
    assert set(by) == {r["doc_id"] for r in odd.collect()} and by[1] == by[2] == by[3] == 1
    assert by[6] == 2 * next(r["doc_tokens"] for r in rows if r["doc_id"] == 6)
    assert op5_packing.pack(odd.limit(0)).count() == 0


def test_first_fit_is_the_first_bin():
    import random
    r = random.Random(5)
    need = [r.randint(1, 2048) for _ in range(500)]
    tree, room = op5_packing.Tournament(len(need), 2048), [2048] * len(need)
    for n in need:
        want = next(i for i, x in enumerate(room) if x >= n)
        room[want] -= n
        assert tree.place(n) == want


def test_language_held_out(spark, documents):
    got = op6_language.identify(documents.select("doc_id", "text", "lang")).collect()
    out = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in out} == {r["doc_id"] for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1}
    assert sum(r["lang"] == r["lang_pred"] for r in out) >= 0.95 * len(out)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_odd_rows(spark, odd):
    got = op6_language.identify(odd).collect()
    assert len(got) == odd.count()
    by = {r["doc_id"]: r for r in got if r["doc_id"]}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (1, 2, 3, 8))
    assert by[4]["lang_pred"] == "en" and by[4]["fp"] == "keep x"
    none = op6_language.identify(odd.selectExpr("* except (lang)", "CAST(NULL AS STRING) AS lang"))
    assert {r["lang_pred"] for r in none.collect()} == {"und"}
    assert op6_language.identify(odd.limit(0)).count() == 0


def test_language_prototypes_do_not_depend_on_partitions(spark, documents):
    assert op6_language.fit(documents.repartition(7)) == op6_language.fit(documents.coalesce(1))


def test_shards_obey_the_law(spark):
    docs = [(i, f"text {i}") for i in range(400)] + [(1000 + i, "a copy") for i in range(200)]
    docs += [(2000 + i, f"pair {i // 2}") for i in range(120)] + [(None, None), (None, None)]
    got = op8_sharding.assign(spark.createDataFrame(docs, "doc_id long, text string"), shards=8).collect()
    assert len(got) == len(docs)
    shards = defaultdict(list)
    spread = defaultdict(set)
    for r in got:
        shards[r["shard"]].append(r["slot"])
        spread[r["group_key"]].add(r["shard"])
        assert r["law"] == "rows" and r["grown_shard"] is None
    sizes = [len(s) for s in shards.values()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    text = {r["doc_id"]: r["text_crc32"] for r in got}
    assert text[3] == zlib.crc32(b"text 3")
    pairs = [s for k, s in spread.items() if k == hashlib.md5(b"pair 1").hexdigest()]
    cut = sum(len(s) > 1 for s in spread.values())
    assert len(pairs[0]) == 1 and cut <= 3


def test_shards_odd_rows(spark, odd):
    got = op8_sharding.assign(odd).collect()
    assert len(got) == odd.count() and {r["size"] for r in got if r["doc_id"] in (1, 2)} == {16}
    assert op8_sharding.assign(odd.limit(0)).count() == 0


def brute_passages(docs, window):
    seen, out = set(), {}
    for i, t in sorted(docs, key=lambda d: d[0]):
        w = re.findall("[^\x20\x09-\x0d]+", t or "")
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            k = tuple(w[s:s + window])
            if k in seen:
                gone[s:s + window] = [True] * window
            seen.add(k)
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


@pytest.mark.parametrize("part_rows", [2000, 3])
def test_passages_against_brute_force(spark, documents, part_rows):
    docs = [(r["doc_id"], r["text"]) for r in documents.collect()]
    docs += [(10_000, "a b " * 300), (10_001, "a b " * 15 + "c " * 40), (10_002, None), (10_003, "é ü " * 30 + "x")]
    got = op9_substring.dedup_passages(spark.createDataFrame(docs, "doc_id long, text string"), shard_bytes=60_000,
                                       part_rows=part_rows).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in got} == brute_passages(docs, 20)


def test_passages_odd_rows(spark, odd):
    got = op9_substring.dedup_passages(odd).collect()
    assert len(got) == odd.count()
    by = {r["doc_id"]: r for r in got if r["doc_id"]}
    assert by[1]["kept_text"] == "" and by[3]["n_words"] == 0 and by[5]["kept_text"] == "one two three"
    assert len({(r["n_removed"], r["kept_text"]) for r in got if r["doc_id"] == 6}) == 1
    assert op9_substring.dedup_passages(odd.limit(0)).count() == 0


def test_kneser_ney_passes(spark, monkeypatch):
    """Documents scored in passes get the figures of one pass, and the model's tables are gone after the last."""
    import glob

    from ledgerline.session import _scratch_root
    docs = spark.createDataFrame([(i if i % 9 else None, f"text number {i % 7} of the lot " * (i % 5), "en") for i in range(60)],
                                 "doc_id long, text string, lang string").coalesce(1)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 60, 3)], "doc_id long, quality int, toxic int")
    log2 = op1_kneser_ney.train(docs, labels)

    def rows():
        return sorted((x["doc_id"] or -1, x["n_chars"], round(x["log2_ppl"] or -1.0, 6))
                      for x in op1_kneser_ney.perplexities(docs, labels, log2).collect())

    one = rows()
    monkeypatch.setattr(op1_kneser_ney, "PASS_CHARS", 100)
    assert rows() == one and len(one) == 60
    root = _scratch_root(spark).removeprefix("file:")
    assert glob.glob(f"{root}/kn-scores-*") and not glob.glob(f"{root}/kn-model-*")
