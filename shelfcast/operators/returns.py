"""Customer history of return transactions, derived without ever sorting one customer in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000


HOUR, SECOND = 3_600_000_000, 1_000_000


def _before(level: DataFrame, group: list[str], order: str, suffix: str, *more: Column) -> DataFrame:
    """Per row of ``level`` what earlier rows of its group add up to: count delta and latest purchase; and ``more``."""
    earlier = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return level.select(
        *group,
        order,
        F.coalesce(F.sum("delta").over(earlier), F.lit(0)).alias(f"open_{suffix}"),
        F.max("bought_at").over(earlier).alias(f"bought_{suffix}"),
        *more,
    )


def _rolled(level: DataFrame, keys: list[str]) -> DataFrame:
    return level.groupBy(*keys).agg(
        F.sum("delta").alias("delta"), F.max("bought_at").alias("bought_at"), F.min("first_at").alias("first_at")
    )


def _join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on equal keys, NULL equal to NULL."""
    renamed = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return left.join(renamed, same).drop(*[f"_{k}" for k in keys])


def derive_history(activity: DataFrame) -> DataFrame:
    """Add ``return_frequency_24h``, ``days_since_purchase`` and ``customer_tenure_days``.

    * frequency: returns of the customer in the 24 hours before the row, the row's own instant excluded
    * days since purchase: whole days since the customer's latest earlier purchase, NULL if none
    * tenure: whole days since the customer's first event

    A customer may own a third of the log, so no window spans a customer's rows. A return counts +1 at its
    instant and -1 one day later, which turns the sliding count into a running sum. The log is first
    aggregated (map-side) to distinct instants, those to seconds, those to hours. Running sums are then
    taken level by level: hours of a customer, seconds of an hour, instants of a second. The calendar
    bounds each of these groups, however many rows there are. Rows without a customer or time are kept,
    as one customer and as the earliest instant.
    """
    at = F.unix_micros("ts")
    moment = F.struct(at.alias("at"), F.col("is_return").cast("int").alias("delta"), F.lit(True).alias("is_row"))
    leave = F.struct((at + DAY_MICROS).alias("at"), F.lit(-1).alias("delta"), F.lit(False).alias("is_row"))
    entries = activity.select(
        "customer_id",
        F.when(F.col("is_purchase"), at).alias("bought"),
        F.explode(F.when(F.col("is_return"), F.array(moment, leave)).otherwise(F.array(moment))).alias("e"),
    )
    instants = entries.groupBy("customer_id", F.col("e.at").alias("at")).agg(
        F.sum("e.delta").alias("delta"),
        F.max(F.when(F.col("e.is_row"), F.col("bought"))).alias("bought_at"),
        F.min(F.when(F.col("e.is_row"), F.col("e.at"))).alias("first_at"),
    )
    instants = instants.withColumns({"second": F.floor(F.col("at") / SECOND), "hour": F.floor(F.col("at") / HOUR)})
    seconds = _rolled(instants, ["customer_id", "hour", "second"])
    hours = _rolled(seconds, ["customer_id", "hour"])
    # the customer's first instant comes along with the hours, whose number the calendar bounds
    joined_at = F.min("first_at").over(Window.partitionBy("customer_id")).alias("joined_at")

    history = _before(instants, ["customer_id", "hour", "second"], "at", "instant")
    history = _join(history, _before(seconds, ["customer_id", "hour"], "second", "second"), ["customer_id", "hour", "second"])
    history = _join(history, _before(hours, ["customer_id"], "hour", "hour", joined_at), ["customer_id", "hour"])
    # later levels hold later purchases: the nearest level with one decides
    bought = F.coalesce("bought_instant", "bought_second", "bought_hour")
    history = history.select(
        "customer_id",
        "at",
        (F.col("open_hour") + F.col("open_second") + F.col("open_instant")).alias("return_frequency_24h"),
        F.floor((F.col("at") - bought) / DAY_MICROS).alias("days_since_purchase"),
        F.floor((F.col("at") - F.col("joined_at")) / DAY_MICROS).alias("customer_tenure_days"),
    )
    joined = _join(activity.withColumn("at", at), history, ["customer_id", "at"])
    return joined.select(*activity.columns, "return_frequency_24h", "days_since_purchase", "customer_tenure_days")
