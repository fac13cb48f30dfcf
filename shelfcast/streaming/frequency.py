"""Returns per customer in sliding 24-hour windows over an event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def return_frequency_stream(
    activity: DataFrame, late: str = "1 hour", length: str = "24 hours", slide: str = "1 hour"
) -> DataFrame:
    """Count per (customer, window) on an hourly grid; append mode, closed windows only.

    Rows are counted before the state shuffle, so a very active customer sends few rows per batch.
    Rows later than ``late`` behind the newest event are dropped by the watermark.
    """
    return (
        activity.where("is_return")
        .withWatermark("ts", late)
        .groupBy(F.window("ts", length, slide), "customer_id")
        .agg(F.count("*").alias("returns_24h"))
        .select("customer_id", F.col("window.start").alias("start"), F.col("window.end").alias("end"), "returns_24h")
    )
