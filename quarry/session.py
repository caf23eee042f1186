"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings every query in this package assumes. AQE re-plans joins at run time
# (broadcast only when the *measured* side is small), coalesces small shuffle
# partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoints written by the positional operators are removed once the
    # DataFrame that owns them is garbage-collected on the driver
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app_name: str = "quarry",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Return a session with the package defaults.

    ``master`` defaults to ``local[*]`` only when no master is configured, so
    the same call works under ``spark-submit`` on a cluster.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    elif not os.environ.get("SPARK_MASTER") and "MASTER" not in os.environ:
        builder = builder.master("local[*]")
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only where none is set.

    On a cluster the folder must be shared storage named by
    ``spark.checkpoint.dir``; it is never invented there. In local mode
    (tests, the bench) a fresh scratch folder is created if nothing is set.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the checkpoint folder
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set on the server; point it at shared storage") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage (HDFS/S3/...) "
            "so lineage can be cut reliably on a cluster")
    path = tempfile.mkdtemp(prefix="quarry-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder: lineage is cut, any executor may be
    lost afterwards, and a second use does not compute it again."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: dict[str, tempfile.TemporaryDirectory | None] = {}


def ship_package(spark: SparkSession) -> None:
    """Let the executors' Python workers import this package where PYTHONPATH does not: Spark's file
    server gives them a zip of it, which the driver keeps until it ends."""
    app, root = spark.sparkContext.applicationId, Path(__file__).resolve().parents[1]
    if app in _shipped:
        return
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        _shipped[app] = None
        return
    _shipped[app] = folder = tempfile.TemporaryDirectory()
    to = Path(folder.name) / f"quarry-{app}.zip"
    with zipfile.ZipFile(to, "w") as z:
        for f in sorted((root / "quarry").rglob("*.py")):
            z.write(f, f.relative_to(root))
    spark.sparkContext.addPyFile(str(to))
