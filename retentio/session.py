"""Session construction and shared configuration."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every query in this package assumes.  ANSI stays on (Spark 4
# default); all divisions go through try_divide so codegen keeps working.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Core settings applied when this module creates the context: checkpoint
# files of collected references are cleaned in long-lived sessions.
CONTEXT_CONF = {
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "retentio",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the package defaults.

    ``master`` is only applied when given: on a cluster the launcher decides.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**BASE_CONF, **CONTEXT_CONF}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k, v in BASE_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the session's ``spark.checkpoint.dir``; set one only when unset.

    The fallback lies in the warehouse folder.  On a cluster that folder must name a shared store
    (a path with a scheme other than ``file``): a folder of the driver's machine would be
    lost to the executors, so it is refused.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        shared = "://" in warehouse or warehouse.split(":")[0] not in ("file", warehouse)
        if not sc.master.startswith("local[") and sc.master != "local" and not shared:
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = os.path.join(warehouse, "_checkpoints")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    return os.path.join(checkpoint_dir(spark), name)
