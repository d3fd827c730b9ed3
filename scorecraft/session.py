"""Session construction and the shared checkpoint folder.

On a cluster the session is created by the platform; ``get_session`` only adds
defaults that are unset.  Lineage is cut with reliable ``checkpoint()`` and written
tables in the folder named by ``spark.checkpoint.dir`` (never ``localCheckpoint``).
On a cluster a session without that folder is an error; only a local master, whose
tasks all run on this machine, gets a private one, removed when Python ends.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "scorecraft") -> SparkSession:
    """Return the active session or build one with scale-friendly defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; a private one only for a local master without any."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="scorecraft-ckpt-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a staged table, under one folder per application, which can
    be deleted when the application has ended."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "staged", spark.sparkContext.applicationId, f"{name}-{uuid.uuid4().hex[:12]}")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet into the shared folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def shuffle_partitions(spark: SparkSession, least: int):
    """At least so many shuffle partitions for what runs inside; adaptive execution may
    still coalesce them."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(max(int(before), least)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Cache a frame for the passes of a fit and release it afterwards; lazy
    results built on it recompute from their source when executed later."""
    df = df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
