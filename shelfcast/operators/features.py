"""Feature columns: calendar, elapsed time, per-store history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from shelfcast.functions.elapsed import months_since, weeks_since_iso_week
from shelfcast.functions.money import ratio, units
from shelfcast.schema import LAGS, WINDOWS

# Rows that a task of the segmented history sorts; for small tables the least that is worth a task
_TASK_ROWS = 200_000
_LEAST_ROWS = 16_384


def calendar_features(df: DataFrame) -> DataFrame:
    date = F.col("date")
    return df.select(
        "*",
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        F.dayofmonth(date).alias("day"),
        F.quarter(date).alias("quarter"),
        F.weekofyear(date).alias("week_of_year"),
        F.coalesce(F.col("day_of_week").isin(6, 7).cast("int"), F.lit(0)).alias("is_weekend"),
        F.col("promo").cast("int").alias("is_promo"),
    )


def elapsed_features(df: DataFrame) -> DataFrame:
    months = months_since(F.col("date"), F.col("competition_open_year"), F.col("competition_open_month"))
    weeks = weeks_since_iso_week(F.col("date"), F.col("promo2_since_year"), F.col("promo2_since_week"))
    return df.select("*", months.alias("months_since_competition"), weeks.alias("weeks_since_promo2"))


def _history(ordered: WindowSpec, lags: Sequence[int], windows: Sequence[int]) -> list[Column]:
    sales = F.col("sales")
    columns = [F.lag(sales, n).over(ordered).alias(f"sales_lag_{n}") for n in lags]
    for n in windows:
        # the previous n rows: the row's own sales must not leak into its features
        frame = ordered.rowsBetween(-n, -1)
        mean = ratio(F.sum(units(sales)).over(frame), F.count(sales).over(frame))
        columns += [
            mean.alias(f"sales_rolling_mean_{n}"),
            F.stddev_samp(sales).over(frame).alias(f"sales_rolling_std_{n}"),
        ]
    return columns


def history_features(df: DataFrame, lags: Sequence[int] = LAGS, windows: Sequence[int] = WINDOWS) -> DataFrame:
    """Lags and rolling statistics per store over its open days (positions, not calendar days).

    All columns are in one select over one window: one exchange and one sort for the whole set. The
    panel has one row per (store, date), so a store's group is bounded by the length of the calendar.
    For a source whose key is not known to be unique use ``segmented_history_features``.
    """
    ordered = Window.partitionBy("store_id").orderBy("date", "sales")
    return df.select("*", *_history(ordered, lags, windows))


def segmented_history_features(
    df: DataFrame,
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = WINDOWS,
    segment_rows: int = 100_000,
) -> DataFrame:
    """The same columns when one store may own a large part of the rows.

    Every row gets its exact position in its store: the rows of earlier dates (counted per store and date,
    prefix-summed over the calendar) plus its position among the rows of its own date, smaller sales
    first. Rows without a date come first, as in the plain variant. Positions are cut into segments of
    ``segment_rows``; the last rows of a segment, as far as the longest lag reaches, are also sent to the
    next one as context. A task then sorts at most one segment and its context, or the rows of one store
    and date, whatever the store's share. The rows are counted first, and the number of tasks follows from that,
    so a task's memory does not grow with the table: a caller with an expensive frame stages it.
    """
    reach = max([*lags, *windows])
    if segment_rows <= reach:
        raise ValueError("a segment must be longer than the longest lag")
    n, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    parts = max(1, -(-n // _TASK_ROWS), min(cores, -(-n // _LEAST_ROWS)))
    # keys without NULL, so that one exchange serves the ranks within a date and the join
    store, date = F.col("store_id"), F.col("date")
    keyed = df.withColumns(
        {
            "_no_store": store.isNull(),
            "_store": F.coalesce(store, F.lit("0").cast(df.schema["store_id"].dataType)),
            "_no_date": date.isNull(),
            "_date": F.coalesce(date, F.lit("1970-01-01").cast(df.schema["date"].dataType)),
        }
    )
    keys = ["_no_store", "_store", "_no_date", "_date"]
    by_date = Window.partitionBy(*keys[:2]).orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        keyed.groupBy(*keys)
        .agg(F.first("date").alias("date"), F.count("*").alias("_rows"))
        .repartition(parts, *keys[:2])
        .select(*keys, F.coalesce(F.sum("_rows").over(by_date), F.lit(0)).alias("_start"))
    )
    in_date = Window.partitionBy(*keys).orderBy("sales")
    positioned = (
        keyed.repartition(parts, *keys)
        .withColumn("_rank", F.row_number().over(in_date) - 1)
        .join(starts, keys)
        .withColumn("_position", F.col("_start") + F.col("_rank"))
    )
    own = F.floor(F.col("_position") / segment_rows)
    is_context = F.col("_position") % segment_rows >= segment_rows - reach
    copies = F.when(is_context, F.array(own, own + 1)).otherwise(F.array(own))
    segments = positioned.withColumn("_own", own).withColumn("_segment", F.explode(copies))
    segments = segments.repartition(parts, "store_id", "_segment")
    ordered = Window.partitionBy("store_id", "_segment").orderBy("_position")
    return segments.select(*df.columns, "_own", "_segment", *_history(ordered, lags, windows)).where(
        "_own = _segment"
    ).drop("_own", "_segment")


def engineer(days: DataFrame, lags: Sequence[int] = LAGS, windows: Sequence[int] = WINDOWS) -> DataFrame:
    return history_features(elapsed_features(calendar_features(days)), lags, windows)
