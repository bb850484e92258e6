"""Operators with SQL: against DuckDB on whole tables, and their defined results on odd rows."""

import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from ledgerline.llm import op2_line_dedup, op7_decontaminate, op10_rules

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "benchmark", "pages", "labels")


@pytest.mark.parametrize("name", ["op2_winnow_line_dedup", "op7_benchmark_decontamination", "op10_quality_rules"])
def test_oracle(spark, name):
    df = E.queries()[name](spark, SF)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(E.oracle_sql()[name])
    cols = sorted(df.columns)
    assert cols == sorted(d[0] for d in cur.description)
    at = [[d[0] for d in cur.description].index(c) for c in cols]
    want = sorted(tuple(r[i] for i in at) for r in cur.fetchall())
    assert sorted(tuple(r[c] for c in cols) for r in df.collect()) == want
    assert want


def test_rules_plan_is_one_projection(spark, documents):
    plan = op10_rules.quality_rules(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_rules_odd_rows(spark, odd):
    got = op10_rules.quality_rules(odd).collect()
    assert len(got) == odd.count()
    by = {r["doc_id"]: r for r in got if r["doc_id"]}
    assert by[1]["n_words"] == by[2]["n_words"] == by[3]["n_words"] == 0 and not by[1]["kept"]
    assert by[6]["n_words"] == 60_000 and by[8]["n_symbols"] == 3
    assert op10_rules.quality_rules(odd.limit(0)).count() == 0


def test_repeated_window_words(spark):
    def brute(t):
        w = re.findall("[^\x20\x09-\x0d]+", t)
        c = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        return len({i + k for i in range(len(w) - 2) if c[tuple(w[i:i + 3])] > 1 for k in range(3)})

    texts = ["a a a a a", "a b c a b c", "a b c d e", "x a b c y a b c z a b", "", "a b", "q w e r q w e r q w e"]
    got = op10_rules.quality_rules(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["n_repeat_words"] for r in got} == {i: brute(t) for i, t in enumerate(texts)}


def brute_lines(docs, window):
    seen, out = set(), {}
    for i, t in sorted(docs, key=lambda x: x[0]):
        lines = [x.strip(" \t\n\x0b\f\r") for x in (t or "").split("\n")]
        lines = [x for x in lines if x]
        gone = set()
        for s in range(len(lines) - window + 1):
            run = tuple(lines[s:s + window])
            if run in seen:
                gone |= set(range(s, s + window))
            seen.add(run)
        out[i] = (len(lines), len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone) if gone else t)
    return out


def test_line_runs_against_brute_force(spark):
    import random
    r = random.Random(7)
    docs = [(i, "\n".join(r.choice("abcde") for _ in range(r.randint(0, 14)))) for i in range(120)]
    docs += [(200, "b\n" * 5000), (201, None)]
    got = op2_line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {x["doc_id"]: (x["n_lines"], x["n_removed"], x["text"]) for x in got} == brute_lines(docs, op2_line_dedup.WINDOW)


def test_line_dedup_odd_rows(spark, odd):
    out = op2_line_dedup.dedup_lines(odd)
    got = out.collect()
    assert len(got) == odd.count() and "fp" in out.columns
    by = {r["doc_id"]: r for r in got if r["doc_id"]}
    assert by[1]["text"] is None and by[2]["text"] == "" and by[9]["n_removed"] == 0
    assert by[10]["text"] == "other end" and by[10]["n_removed"] == 3 and by[6]["n_removed"] == 0
    assert op2_line_dedup.dedup_lines(odd.limit(0)).count() == 0


def test_leaks_in_long_documents(spark, odd):
    item = "the quick brown fox jumps over the lazy dog near the river bank today"
    pad = " ".join(f"filler{i}" for i in range(40_000))
    docs = spark.createDataFrame([
        (1, f"{pad} {item.upper()}! {pad}"), (2, item.replace("lazy", "sleepy")), (3, pad), (4, None),
        (5, f"{pad} " + item.replace(" ", ", ")), (5, f"{pad} " + item.replace(" ", ", ")), (None, item)],
        "doc_id long, text string")
    items = spark.createDataFrame([(10, item), (11, "too short"), (12, None), (None, item)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in op7_decontaminate.contaminated(docs, items).collect()}
    assert got == {(d, i) for d in (1, 5, None) for i in (10, None)}
    assert op7_decontaminate.contaminated(docs, items.limit(0)).count() == 0
    assert op7_decontaminate.contaminated(docs.limit(0), items).count() == 0
    left = op7_decontaminate.drop_contaminated(docs, items)
    assert sorted(r["doc_id"] for r in left.collect()) == [2, 3, 4]
    assert op7_decontaminate.drop_contaminated(odd, items).columns == odd.columns


@pytest.mark.parametrize("lost", [0, 1, 2, 3])
def test_containment_is_complete(spark, lost):
    """Every document that keeps 80 % of the shingles is found, wherever the lost ones are."""
    words = [f"w{i}" for i in range(34)]  # 30 shingles: up to 6 may be absent
    docs = []
    for k in range(0, 30):
        w = list(words)
        for j in range(lost):
            w[(k + 11 * j) % 34] = f"x{j}"
        docs.append((k, " ".join(w)))
    got = op7_decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                                         spark.createDataFrame([(1, " ".join(words))], "item_id long, text string"))
    sh = {tuple(words[i:i + 5]) for i in range(30)}
    want = {k for k, t in docs if len(sh & {tuple(t.split()[i:i + 5]) for i in range(30)}) >= 24}
    assert {r["doc_id"] for r in got.collect()} == want
