"""Spark session helpers.

Cluster settings (shuffle partitions, checkpoint dir, memory) come from the
session the caller owns; ``get_spark`` only fills in defaults for local runs.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8, app: str = "tenderflow") -> SparkSession:
    """Return the active session, or build a local one with sane defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app).master(master or os.environ.get("TENDERFLOW_MASTER", "local[8]"))
    for k, v in LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("TENDERFLOW_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    ``spark.checkpoint.dir`` if set, else a folder the caller has set on the context. With neither, a scratch
    folder is used on a local master only: on a cluster a folder of the driver's own is refused. The choice is
    kept on the context, since the setting itself cannot change while the session runs.
    """
    context = spark.sparkContext
    path = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    path = path or context.getCheckpointDir()
    if not path:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="tenderflow-ckpt-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(path)
    return path


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the jobs that run inside the block; what was set before comes back."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder for intermediate tables under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", name) if "://" not in base else f"{base.rstrip('/')}/tables/{name}"
