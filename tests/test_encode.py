"""First-seen codes against a dict loop; batch extension equals one-shot encoding."""

from pyspark.sql import functions as F

from ledgerline.operators.encode import encode_transactions
from ledgerline.operators.rank import rank_unique, with_row_index
from ledgerline.sources.fixtures import batches


def dict_loop(rows):
    acct, cur, fmt = {}, {}, {}

    def get(v, d):
        if v not in d:
            d[v] = len(d)
        return d[v]
    out = []
    for r in rows:
        rc = get(r["Receiving Currency"], cur)
        pc = get(r["Payment Currency"], cur)
        pf = get(r["Payment Format"], fmt)
        f = get(r["From Bank"] + r["Account"], acct)
        t = get(r["To Bank"] + r["Account.1"], acct)
        out.append((r["row_id"], f, t, pc, rc, pf))
    return out


def test_first_seen_codes_match_dict_loop(raw):
    t, n = raw
    rows = sorted(t.collect(), key=lambda r: r["row_id"])
    want = dict_loop(rows)
    e, _ = encode_transactions(t, index_offset=0, n_rows=n)
    got = sorted((r["Index"], r["From_ID"], r["To_ID"], r["Payment_Currency"], r["Receiving_Currency"],
                  r["Payment_Format"]) for r in e.collect())
    assert got == want


def test_extend_equals_one_shot(raw):
    t, n = raw
    train, score, cut, n = batches(t, n)
    _, s1 = encode_transactions(train, index_offset=0, n_rows=cut)
    e2, s2 = encode_transactions(score, s1, index_offset=cut, n_rows=n - cut)
    _, one = encode_transactions(t, index_offset=0, n_rows=n)
    for d in ("account", "currency", "payment_format"):
        a = sorted(tuple(r) for r in s2.dims[d].collect())
        b = sorted(tuple(r) for r in one.dims[d].collect())
        assert a == b, d
    assert s2.anchor == one.anchor
    assert e2.agg(F.min("Index")).first()[0] == 0  # Index restarts per batch


def test_row_index_is_dense_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"))
    idx = with_row_index(df, ["k"], name="i", num_partitions=5)
    rows = sorted((r["k"], r["i"]) for r in idx.collect())
    assert [i for _, i in rows] == list(range(5000))


def test_rank_unique_small_buckets(spark):
    df = spark.range(0, 3000).select((F.col("id") * 3 + 11).alias("p"))
    r = rank_unique(df, "p", name="r", start=5, bucket_width=64)
    got = sorted((x["p"], x["r"]) for x in r.collect())
    assert got == [(p, i + 5) for i, (p, _) in enumerate(got)]


def test_quarantine_splits_bad_rows(spark, raw):
    from ledgerline.sources.fixtures import dirty
    t, n = raw
    e, _, rejects = encode_transactions(dirty(t), on_error="quarantine", index_offset=0, n_rows=n)
    assert e.count() + rejects.count() == n
    assert rejects.count() > 0
