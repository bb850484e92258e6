"""Model registry (S7, K6, O2, C9, C11, C12): versioned model folders ``model_yyyyMMdd_HHmmss``.

The newest model is the largest full version (date and time), picked with ``max_by`` over
a listing table, one row per registry.
"""

from __future__ import annotations

import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import basename, c, last_part

# Folder name layout of a saved model.
VERSION_PATTERN = r"model_(\d{8}_\d{6})$"
PREFIX = "model_"


def with_version(listing: DataFrame, path: str = "path") -> DataFrame:
    """Adds ``name`` (base name), ``version`` (``yyyyMMdd_HHmmss``) and ``time_part`` (``HHmmss``)."""
    name = basename(path)
    return listing.withColumn("name", name).withColumn(
        "version", F.regexp_extract(F.col("name"), VERSION_PATTERN, 1)).withColumn(
        "time_part", last_part("version"))


def latest_model(listing: DataFrame, path: str = "path", by: list[str] | None = None) -> DataFrame:
    """One row per registry (``by``): the path with the largest version."""
    v = with_version(listing, path).where(F.col("version") != "")
    by = by or []
    return v.groupBy(*[c(b) for b in by]).agg(
        F.max_by(c(path), F.col("version")).alias("latest_path"), F.max("version").alias("version"))


def list_models(spark: SparkSession, registry: str) -> DataFrame:
    """Listing table of a registry folder (one row per model folder)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(registry)
    fs = p.getFileSystem(conf)
    found = [st.getPath() for st in fs.listStatus(p) if st.isDirectory()] if fs.exists(p) else []
    # ``meta`` (a forest with its ranges) or ``metadata`` (any other Spark model): without it a folder is no model yet.
    whole = [x for x in found if any(fs.exists(jvm.org.apache.hadoop.fs.Path(x, m)) for m in ("meta", "metadata"))]
    rows = [(x.toString(),) for x in whole]
    return spark.createDataFrame(rows, "path string")


def save_model(model, registry: str, version: str | None = None) -> str:
    """K6: save a fitted model (anything with ``save(path)``) under a new version folder; returns its path."""
    path = os.path.join(registry, PREFIX + (version or _free_version(registry)))
    model.save(path)
    return path


def _free_version(registry: str) -> str:
    """The version stamp of now, or the first later second that has no model yet."""
    spark = SparkSession.getActiveSession()
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = int(time.time())
    while True:
        version = time.strftime("%Y%m%d_%H%M%S", time.gmtime(at))
        p = jvm.org.apache.hadoop.fs.Path(os.path.join(registry, PREFIX + version))
        if not p.getFileSystem(conf).exists(p):
            return version
        at += 1
