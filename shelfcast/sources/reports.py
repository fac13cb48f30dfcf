"""Report sources and sinks: JSON, CSV, alert feed."""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession

from shelfcast.sources.tables import exists


def write_report(report: DataFrame, path: str) -> None:
    """A report is a few aggregated rows: one JSON file."""
    report.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_facts(spark: SparkSession, facts: dict, path: str) -> None:
    """One-row report from a nested dict of scalars, lists and maps."""
    spark.createDataFrame([(json.dumps(facts),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_report(spark: SparkSession, path: str) -> DataFrame | None:
    """A JSON report (records or one nested object); None when missing or when any of it is not JSON."""
    if not exists(spark, path):
        return None
    reader = spark.read.option("mode", "FAILFAST").option("multiLine", not path_is_lines(spark, path))
    try:
        table = reader.json(path)  # reading the schema parses every record
    except (PySparkException, Py4JJavaError) as error:
        if "MALFORMED" not in str(error).upper() and not isinstance(error, AnalysisException):
            raise
        return None
    return table if table.columns else None


def path_is_lines(spark: SparkSession, path: str) -> bool:
    """Whether the text has one JSON object per line (what Spark writes)."""
    first = spark.read.text(path).first()
    if first is None:
        return True
    try:
        json.loads(first["value"])
        return not first["value"].lstrip().startswith("[")
    except ValueError:
        return False


def write_csv(table: DataFrame, path: str) -> None:
    table.write.mode("overwrite").option("header", True).csv(path)


def write_alert_feed(alerts: DataFrame, path: str) -> None:
    """Alert records with ISO timestamps; the ground truth never leaves the job."""
    alerts.drop("label", "is_train").write.mode("overwrite").option(
        "timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"
    ).json(path)


def write_panel(train: DataFrame, val: DataFrame, folder: str, replace: bool = True) -> None:
    """Parquet of both parts, by year.

    With ``replace`` the tables are written anew; without, only the years that the new rows belong to.
    """
    mode = "static" if replace else "dynamic"
    for part, name in ((train, "train_processed"), (val, "val_processed")):
        writer = part.write.mode("overwrite").option("partitionOverwriteMode", mode)
        if "year" in part.columns:
            writer = writer.partitionBy("year")
        writer.parquet(f"{folder.rstrip('/')}/{name}.parquet")
