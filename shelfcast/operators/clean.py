"""Cleaning of the raw panel: open days, anomaly flag, imputation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.order_stats import weighted_quantile
from shelfcast.session import stage


def open_days(panel: DataFrame) -> DataFrame:
    """Keep open days; mark (not drop) open days without sales."""
    marked = F.coalesce((F.col("sales") == 0).cast("int"), F.lit(0))
    return panel.where(F.col("open_flag") == 1).withColumn("is_zero_sales_anomaly", marked)


def median_by_value(df: DataFrame, column: str) -> float | None:
    """Exact median over the rows of ``df``, as a number.

    Rows are counted per value (map-side) in one narrow pass; the rank is then searched over these counts, so
    neither the rows nor the distinct values meet in one task.
    """
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("days"))
    return weighted_quantile(stage(counted, "days-by-value"), column, "days", 0.5)


def impute_known(days: DataFrame) -> DataFrame:
    """The part of the imputation policy that needs no statistic.

    * competition and second-promotion dates: 0, with a flag for a known competition date
    * promotion interval: empty text; state holiday: text, "0.0" and "0" are the same
    """
    known = F.col("competition_open_month").isNotNull() & F.col("competition_open_year").isNotNull()
    holiday = F.coalesce(F.col("state_holiday").cast("string"), F.lit("nan"))
    zero = [
        "competition_open_month",
        "competition_open_year",
        "promo2_since_week",
        "promo2_since_year",
    ]
    return days.withColumns(
        {
            "has_competition_open_date": known.cast("int"),
            **{c: F.coalesce(F.col(c), F.lit(0)) for c in zero},
            "promo_interval": F.coalesce("promo_interval", F.lit("")),
            "state_holiday": F.when(holiday == "0.0", "0").otherwise(holiday),
        }
    )


def impute_distance(days: DataFrame) -> DataFrame:
    """Competition distance: median over the open day rows, so busy stores weigh more.

    The rows are read for the median and again by the result: a caller with an expensive frame stages it.
    """
    median = F.lit(median_by_value(days, "competition_distance")).cast("double")
    return days.withColumn("competition_distance", F.coalesce("competition_distance", median))


def impute(days: DataFrame) -> DataFrame:
    """Imputation policy: ``impute_distance`` and ``impute_known``."""
    return impute_known(impute_distance(days))


def clean(panel: DataFrame) -> DataFrame:
    return impute(open_days(panel))
