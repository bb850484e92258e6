"""Session helpers: building a session for tests/bench and finding shared scratch space.

On a cluster the shared folder comes from ``spark.checkpoint.dir``; this module only
invents one (under the system temp dir) when the session has none, which is the case
for unit tests on ``local[*]``.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "ledgerline",
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting it only when the session has none."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set: executors need a shared folder for written tables")
        conf_dir = tempfile.mkdtemp(prefix="ledgerline-ckpt-")  # one machine only
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written intermediate tables."""
    path = os.path.join(_scratch_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    if getattr(_NOTED, "paths", None) is not None:
        _NOTED.paths.append(path)
    return path


_NOTED = threading.local()


@contextmanager
def scratch_given_back(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch tables written inside (by this thread) at the end; nothing may read them later."""
    before, _NOTED.paths = getattr(_NOTED, "paths", None), []
    try:
        yield
    finally:
        paths, _NOTED.paths = _NOTED.paths, before
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(hadoop).delete(p, True)


def _scratch_root(spark: SparkSession) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), "ledgerline", spark.sparkContext.applicationId)


def release_scratch(spark: SparkSession) -> None:
    """Delete this application's written intermediate tables; call when its results are stored elsewhere."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def freeze(df, name: str, partition_by: list[str] | None = None):
    """Write ``df`` to a fresh table in the shared checkpoint folder and read it back.

    Cuts the lineage (small plans, no recomputation, survives lost executors); use at
    state boundaries: dictionaries, encoded batch, edge table, node table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path)  # an empty result has no file to infer from


def drop_frozen(df) -> None:
    """Delete a table that ``freeze`` wrote and that nothing reads any more."""
    spark = df.sparkSession
    root, hadoop = _scratch_root(spark), spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if spark.sparkContext.applicationId not in folder or os.path.basename(root) == os.path.basename(folder):
            raise ValueError(f"{folder} is not a table of {root}")
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        p.getFileSystem(hadoop).delete(p, True)


_SHIPPED: set[str] = set()


def ship_code(spark) -> None:
    """Give the Python workers this package, as ``--py-files`` would; once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    if not (root / "ledgerline").is_dir():  # already running from an archive
        return
    # The driver's own copy; addPyFile sends it to every executor.
    archive = os.path.join(tempfile.mkdtemp(prefix="ledgerline-code-"), "ledgerline_code.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted((root / "ledgerline").rglob("*.py")):
            z.write(f, f.relative_to(root))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)
