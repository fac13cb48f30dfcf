"""Time-ordered splits: holdout weeks, expanding folds, train and monitor windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.order_stats import RankIndex, precedes
from shelfcast.schema import VALIDATION_WEEKS


def cutoff_date(panel: DataFrame, weeks: int = VALIDATION_WEEKS) -> Column:
    """Last training date as a scalar subquery: the plan stays lazy and needs no join."""
    return panel.agg(F.date_sub(F.max("date"), 7 * weeks).alias("cutoff")).scalar()


def with_part(panel: DataFrame, weeks: int = VALIDATION_WEEKS) -> DataFrame:
    """Add ``part``, train or val, in one pass over the panel. Rows without a date have no part."""
    in_train = F.col("date") <= cutoff_date(panel, weeks)
    return panel.withColumn("part", F.when(in_train, "train").when(~in_train, "val"))


def holdout_split(panel: DataFrame, weeks: int = VALIDATION_WEEKS) -> tuple[DataFrame, DataFrame]:
    """Rows up to the cutoff, and the last ``weeks`` weeks; the same dates for every store."""
    cutoff = cutoff_date(panel, weeks)
    return panel.where(F.col("date") <= cutoff), panel.where(F.col("date") > cutoff)


def nulls_last(column: str) -> list[Column]:
    """Two keys without gaps that order ``column`` with NULL after all values."""
    return [F.col(column).isNull().cast("int"), F.coalesce(F.col(column), F.lit(0)).cast("bigint")]


def temporal_folds(panel: DataFrame, splits: int = 3) -> DataFrame:
    """Add ``fold``: 0 for rows only ever trained on, i for the validation rows of fold i.

    Fold i trains on all rows with a smaller fold number. Sizes follow the row order (date, store):
    every validation part has ``n // (splits + 1)`` rows, the remainder goes to the first train part.
    Rows without a date or store come after all others. The keys are read twice (counts by day, rows of the
    days with a cut), the panel once more by the result: a caller with an expensive panel stages it.
    """
    keyed = panel.withColumns({"_day": F.unix_date("date"), "_store": F.col("store_id").cast("bigint")})
    index = RankIndex(keyed.select("_day", "_store"), ["_day", "_store"])
    size = index.n // (splits + 1)
    if size == 0:
        raise ValueError(f"cannot cut {index.n} rows into {splits} folds")
    starts = index.cuts([index.n - size * (splits - i) for i in range(splits)])
    keys = ["_k0", "_k1", "_k2", "_k3"]
    keyed = keyed.withColumns(dict(zip(keys, [*nulls_last("_day"), *nulls_last("_store")])))
    fold = F.lit(splits)
    for i in reversed(range(splits)):
        fold = F.when(precedes(keys, starts[i]), i).otherwise(fold)
    return keyed.withColumn("fold", fold).drop("_day", "_store", *keys)


HOUR_MICROS = 3_600_000_000


def train_monitor(returns: DataFrame, fraction: float = 0.7) -> DataFrame:
    """Add ``is_train``: the first ``int(n * fraction)`` rows in order of (time, transaction).

    Rows without a time come last, so each row gets a side. The keys are read twice (counts by hour, rows
    of the hour of the cut), the log once more by the result: a caller with an expensive log stages it.
    """
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    keyed = returns.withColumns({"_at": at, "_id": F.col("transaction_id").cast("bigint")})
    index = RankIndex(keyed.select("_at", "_id"), ["_at", "_id"], lambda key: F.floor(key / F.lit(HOUR_MICROS)))
    size = int(index.n * fraction)
    if size >= index.n:
        return returns.withColumn("is_train", F.lit(True))
    (cut,) = index.cuts([size])
    keys = ["_k0", "_k1", "_k2", "_k3"]
    keyed = keyed.withColumns(dict(zip(keys, [*nulls_last("_at"), *nulls_last("_id")])))
    return keyed.withColumn("is_train", precedes(keys, cut)).drop("_at", "_id", *keys)
