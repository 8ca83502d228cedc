"""Session helpers: adaptive execution settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Joins on a subject key may meet a subject that owns a large share of the rows.
# Adaptive execution splits such partitions at run time; forcing it keeps the
# split even where a later step would have liked the partitioning.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def local_session(app: str = "subjectflow", cores: str = "*", partitions: int = 8, shared: str | None = None) -> SparkSession:
    """A session for tests and benchmarks on one machine; ``shared``: its ``spark.checkpoint.dir``."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    for key, value in ADAPTIVE.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune(spark: SparkSession) -> SparkSession:
    """Switch on the adaptive settings the operators rely on."""
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    return spark


_LOCAL: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Where the setting is absent and the master is local there is one process, and a folder
    of this machine will do: one is made, once, and removed when Python ends. On a cluster
    the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by the executors")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="subjectflow-"))
        atexit.register(shutil.rmtree, _LOCAL[0], ignore_errors=True)
    return _LOCAL[0]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/subjectflow/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point ``DataFrame.checkpoint`` at the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
