"""Session defaults and the shared folder used for staged tables."""

from __future__ import annotations

import os
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Defaults for a session this package builds itself; a cluster's own settings win.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "shelfcast", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str | None:
    """The folder all executors can reach, ``spark.checkpoint.dir``; None where it is not set."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        return None
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Keep ``df`` for frames that several jobs scan (training loops, repeated fits).

    With a shared folder it is written there once and read back: a written table survives executor
    loss, cuts the lineage, and keeps column pruning and filter pushdown for the readers. Without one
    nothing is written; the frame is persisted, and Spark computes lost parts again.
    """
    folder = shared_dir(df.sparkSession)
    if folder is None:
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    path = os.path.join(folder, f"{label}-{uuid.uuid4().hex}")
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)
