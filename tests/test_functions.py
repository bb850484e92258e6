"""Scalar functions: timestamp parsing and epoch arithmetic do not depend on the session zone."""

from pyspark.sql import functions as F

from ledgerline.functions.scalar import argmax, basename, epoch_seconds, last_part, midnight_epoch, minmax_scale, parse_ts

ROWS = [("2022/03/13 02:30",), ("bad",), ("2022/13/01 00:00",), ("1995/06/01 23:59",), (None,)]
WANT = [(1647138600, 1647129600), (None, None), (None, None), (802051140, 801964800), (None, None)]


def _run(spark):
    df = spark.createDataFrame(ROWS, "t string")
    ts = parse_ts("t")
    return [tuple(r) for r in df.select(epoch_seconds(ts), midnight_epoch(ts)).collect()]


def test_epoch_is_session_zone_free(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert _run(spark) == WANT, tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_small_helpers(spark):
    df = spark.createDataFrame([("/reg/7/model_20240101_120000/", [0.1, 0.7, 0.2], 5.0)], "p string, a array<double>, x double")
    r = df.select(basename("p").alias("b"), last_part(basename("p")).alias("t"), argmax("a").alias("i"),
                  minmax_scale("x", 0.0, 10.0).alias("s"), minmax_scale("x", 3.0, 3.0).alias("z")).first()
    assert (r["b"], r["t"], r["i"], r["s"], r["z"]) == ("model_20240101_120000", "120000", 1, 0.5, 0.0)
    assert df.select(F.lit(1)).count() == 1
