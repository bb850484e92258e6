"""Merged statistics, inferred types, checks during the write."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import running
from ledgerline.operators.eda import quality_report
from ledgerline.operators.quality import profile
from ledgerline.session import scratch_path
from ledgerline.sinks.writers import write_checked
from ledgerline.sources.readers import cast_columns, infer_types, read_inferred


def test_batches_merge_to_the_exact_profile(spark):
    r = np.random.default_rng(1)
    rows = [(float(v) if i % 7 else None, int(v * 10), f"t{int(v) % 300}" if i % 5 else None, None)
            for i, v in enumerate(r.normal(50, 20, 4_000))]
    df = spark.createDataFrame(rows, "a double, b long, s string, none double").withColumn("i", F.monotonically_increasing_id()).cache()
    root = scratch_path(spark, "sketches")
    cuts = [0, 1, 500, 500, 3_000, 10**12]  # a batch of one row, an empty one
    ranked = df.withColumn("k", F.row_number().over(__import__("pyspark").sql.Window.orderBy("i"))).drop("i").cache()
    for b, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        running.add_batch(ranked.where((F.col("k") > lo) & (F.col("k") <= hi)).drop("k"), root, b)
    running.add_batch(ranked.where("k > 500 AND k <= 3000").drop("k"), root, 3)  # replayed
    got = {(x["feature"], x["stat"]): x["num_value"] for x in running.running_profile(spark, root, (0.1, 0.5)).collect()}
    want = {(x["feature"], x["stat"]): x["num_value"] for x in profile(df.drop("i")).collect()}
    for f in ("a", "b", "none"):
        for stat in ("count", "missing", "num_zeros", "min", "max", "mean", "std_dev"):
            assert got[f, stat] == (pytest.approx(want[f, stat], abs=1e-5) if want[f, stat] is not None else None), (f, stat)
    assert got["s", "count"] == want["s", "count"] and got["s", "avg_length"] == pytest.approx(want["s", "avg_length"])
    assert got["s", "unique"] == pytest.approx(want["s", "unique"], rel=0.05) and got["none", "unique"] == 0
    a = np.sort([x[0] for x in rows if x[0] is not None])
    for q, stat in ((0.1, "q0.1"), (0.5, "median")):
        assert abs(np.searchsorted(a, got["a", stat]) / len(a) - q) < 0.02
    assert got["none", "median"] is None
    # Merging merged rows changes nothing, and the stored rows do not grow with the batches' size.
    stored = running.stored(spark, root)
    assert stored.count() == 5 * 4
    parts = running.merge(stored.where("batch_id < 3")).unionByName(running.merge(stored.where("batch_id >= 3")))
    twice = {(x["feature"], x["stat"]): x["num_value"] for x in running.figures(running.merge(parts), (0.1,)).collect()}
    for k, v in twice.items():
        if k[1] not in ("unique", "q0.1"):
            assert v == (pytest.approx(got[k], abs=1e-5) if got[k] is not None else None), k


def test_types_from_all_rows(spark, tmp_path):
    rows = ["1,2147483648,1.5,true,2022/03/05 1:02,05/03/2022,x,,7",
            " 2 ,3,1e3,FALSE,2022/12/31 23:59,31/12/2022,3,,7.0",
            "-4,5,2,true,2022/01/01 00:00,01/01/2022,2022/01/01,,", ",,,,,,,,"]
    (tmp_path / "t.csv").write_text("h\n" + "\n".join(rows) + "\n")
    names = list("abcdefghi")
    df = read_inferred(spark, str(tmp_path), names)
    assert dict(df.dtypes) == {"a": "int", "b": "bigint", "c": "double", "d": "boolean", "e": "timestamp", "f": "timestamp",
                               "g": "string", "h": "string", "i": "double"}
    got = df.orderBy(F.col("a").asc_nulls_last()).collect()
    assert [r["a"] for r in got] == [-4, 1, 2, None] and got[1]["b"] == 2**31
    assert str(got[2]["f"]) == "2022-12-31 00:00:00" and got[3]["g"] is None
    # One late row decides: nothing is sampled.
    late = spark.range(5_000).select(F.when(F.col("id") < 4_999, F.col("id").cast("string")).otherwise("n/a").alias("v"))
    assert infer_types(late) == {"v": ("string", None)}
    assert infer_types(late.where("v <> 'n/a'")) == {"v": ("int", None)}
    assert infer_types(late.limit(0)) == {"v": ("string", None)}
    assert cast_columns(late.where("v <> 'n/a'"), {"v": ("bigint", None)}).dtypes == [("v", "bigint")]


def test_a_text_that_parses_has_the_shape_of_its_pattern(spark):
    import re

    from ledgerline.functions.scalar import parse_ts
    from ledgerline.sources.readers import NUMBER_SHAPES, TIME_FORMATS, time_shape
    numbers = ["1", " 12 ", "\x7f7\x01", "+0000000000000000000012", "-2147483648", "9223372036854775807", "9223372036854775808", "-1.5", "+.5", "5.", "1e3", "1E-3", "1d", "2F", "NaN", "inf", "-Infinity", "0x1p3", "\t7\n", "8000A", "x", "", "e5", "1 2", "1_0"]
    dates = ["2022/03/05 01:02", "2022/3/5 1:02", "0012/01/01 00:00", "+12022/01/01 00:00", "-0001/01/01 00:00", "2022/003/05 01:02",
             "2022-03-05T01:02:03", "2022-03-05 01:02:03", "2022-03-05", "12/31/2022 23:59", "31/12/2022", "31.12.2022 1:2", "99/99/2022",
             "2022/03/05 01:02:3", "22/03/05", "2022/13/01", "-2022/-3/05", "2022/+3/05"]
    df = spark.createDataFrame([(x,) for x in numbers + dates], "v string")
    tried = 0
    for row in df.select("v", *[F.col("v").try_cast(t).alias(t) for t in NUMBER_SHAPES], *[parse_ts("v", p).isNotNull().alias(p) for p in TIME_FORMATS]).collect():
        for t, shape in NUMBER_SHAPES.items():
            assert row[t] is None or re.search(shape, row["v"]), (row["v"], t)
        for p in TIME_FORMATS:
            fits = re.fullmatch(time_shape(p), row["v"]) is not None
            assert fits or not row[p], (row["v"], p)
            tried += fits
    assert tried < 4 * len(dates)


def test_checks_of_the_write_need_one_pass(spark, raw):
    from ledgerline.sources.fixtures import dirty
    t, _ = raw
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    table = dirty(t).withColumnRenamed("Account.1", "Other")
    path = scratch_path(spark, "checked")
    got = write_checked(table.mapInArrow(count, table.schema), path, ["Amount Paid", "Amount Received"])
    n = table.count()
    assert seen.value == n == spark.read.parquet(path).count()
    want = quality_report(table, ["Amount Paid", "Amount Received"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))
    assert got.agg(F.sum("n_null"), F.sum("n_negative"), F.sum("n_malformed")).first()[0] > 0
