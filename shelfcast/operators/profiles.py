"""One behavioural profile per store, from its open days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.money import mean, mean_when


def raw_profiles(days: DataFrame) -> DataFrame:
    """All stores in one grouped aggregate: partial sums are built map-side, however busy a store is."""
    sales, promo = F.col("sales"), F.col("promo")
    grouped = days.groupBy("store_id").agg(
        mean(sales).alias("avg_daily_sales"),
        F.stddev_samp(sales).alias("spread"),
        *([F.avg("customers").alias("avg_daily_customers")] if "customers" in days.columns else []),
        mean_when(promo == 1, sales).alias("promo_mean"),
        mean_when(promo == 0, sales).alias("other_mean"),
        F.avg(promo).alias("promo_day_share"),
        F.count("*").alias("n_open_days"),
    )
    spread = F.when(F.col("n_open_days") > 1, F.col("spread")).otherwise(0.0)
    cv = F.when(F.col("avg_daily_sales") > 0, spread / F.col("avg_daily_sales")).otherwise(0.0)
    lift = F.when(
        F.col("other_mean") > 0, (F.col("promo_mean") - F.col("other_mean")) / F.col("other_mean") * 100
    ).otherwise(0.0)
    footfall = F.col("avg_daily_customers") if "customers" in days.columns else F.lit(0.0)
    return grouped.select(
        "store_id",
        "avg_daily_sales",
        cv.alias("sales_cv"),
        footfall.alias("avg_daily_customers"),
        lift.alias("promo_lift_pct"),
        "promo_day_share",
        "n_open_days",
    )


def store_profiles(days: DataFrame) -> DataFrame:
    """Profiles without the stores whose sales, volatility or lift cannot be computed."""
    return raw_profiles(days).dropna(subset=["avg_daily_sales", "sales_cv", "promo_lift_pct"])


def low_data_stores(days: DataFrame, share: float = 0.01) -> DataFrame:
    """Threshold of open days and the number of stores below it.

    The percentile buffer is keyed by the number of open days: bounded by the calendar.
    """
    counts = days.groupBy("store_id").agg(F.count("*").alias("n_open_days"))
    threshold = counts.agg(F.percentile("n_open_days", share).alias("t")).scalar()
    return counts.agg(
        F.max(threshold).alias("threshold_days"),
        F.count_if(F.col("n_open_days") < threshold).alias("n_flagged"),
    )
