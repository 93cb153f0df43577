"""Spark session defaults and the shared work folder.

Everything that has to be cut from its lineage (dense keys, materialised
source and mart tables) is written below the folder the cluster names in
``spark.checkpoint.dir``.  A folder of our own is only chosen when that
setting is unset *and* the master is local (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # no Python call-site capture per Column call (3 extra JVM round trips each)
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app_name: str = "starmart", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (cluster jobs get theirs from spark-submit)."""
    master = master or os.environ.get("STARMART_MASTER", "local[8]")
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("STARMART_DRIVER_MEMORY", "8g")
    # file layout for local data sizes (cluster default: 5M rows per file); see sources/store.py
    conf["spark.starmart.maxRecordsPerFile"] = "100000"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, taking it from the session when set."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="starmart-ckpt-"))
    else:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder every executor can reach")
    return sc.getCheckpointDir()


def work_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([root, "starmart", *parts])


def fresh_path(spark: SparkSession, label: str) -> str:
    """A never-used path below the shared folder (one per materialisation)."""
    return work_path(spark, f"{label}-{uuid.uuid4().hex[:12]}")
