"""Model store: time-stamped pipelines plus a manifest table, newest model per name."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.sources.tables import exists

MANIFEST_SCHEMA = "model_name string, stamp string, path string, train_time_sec double, facts string"


def save_model(spark: SparkSession, folder: str, name: str, model: PipelineModel, seconds: float = 0.0, facts: dict | None = None, stamp: str | None = None) -> str:
    """Save under a time-stamped name and append one manifest row; earlier versions stay."""
    stamp = stamp or datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S_%f")
    path = f"{folder.rstrip('/')}/{name}_v{stamp}"
    model.write().save(path)
    row = [(name, stamp, path, float(seconds), json.dumps(facts or {}))]
    spark.createDataFrame(row, MANIFEST_SCHEMA).coalesce(1).write.mode("append").json(f"{folder.rstrip('/')}/manifest")
    return path


def latest_models(manifest: DataFrame) -> DataFrame:
    """Newest entry per model name."""
    others = [c for c in manifest.columns if c not in ("model_name", "stamp")]
    newest = F.max_by(F.struct(*others), "stamp")
    return (
        manifest.groupBy("model_name")
        .agg(F.max("stamp").alias("stamp"), newest.alias("m"))
        .select("model_name", "stamp", *[F.col(f"m.{c}").alias(c) for c in others])
    )


def find_models(spark: SparkSession, folder: str, names=("ridge", "gbt", "mlp")) -> dict[str, tuple[str, float]]:
    """Name -> (path, train seconds): manifest first, else the last name in sort order."""
    folder = folder.rstrip("/")
    found: dict[str, tuple[str, float]] = {}
    if exists(spark, f"{folder}/manifest"):
        manifest = spark.read.schema(MANIFEST_SCHEMA).json(f"{folder}/manifest")
        for row in latest_models(manifest).collect():  # one row per model name
            if exists(spark, row["path"]):
                found[row["model_name"]] = (row["path"], row["train_time_sec"] or 0.0)
    if found:
        return found
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for name in names:
        pattern = hadoop(f"{folder}/{name}_*")
        hits = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern) or []
        paths = sorted(str(h.getPath().toString()) for h in hits)
        if paths:
            found[name] = (paths[-1], 0.0)
    return found


def load_models(spark: SparkSession, folder: str) -> dict[str, PipelineModel]:
    return {name: PipelineModel.load(path) for name, (path, _) in find_models(spark, folder).items()}
