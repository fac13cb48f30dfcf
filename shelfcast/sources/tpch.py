"""The retail tables as derived from the order-line, supplier and event tables under test.

Rules are listed in FIXTURES.md. The planted closed days, zero sales and gaps are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.operators.returns import derive_history
from shelfcast.sources.tables import with_stores


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (store, ship date): the grouping itself makes the key unique."""
    cents = F.floor(F.col("l_extendedprice") * 100 + 0.5)
    share = F.floor((1 - F.col("l_discount")) * 100 + 0.5)
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("store_id"),
        F.col("l_shipdate").cast("date").alias("date"),
        "l_orderkey",
        (cents * share).alias("line_e4"),
        (F.col("l_discount") >= 0.08).cast("int").alias("on_promo"),
    )
    days = lines.groupBy("store_id", "date").agg(
        F.sum("line_e4").alias("day_e4"),
        F.countDistinct("l_orderkey").alias("customers"),
        F.max("on_promo").alias("promo"),
    )
    store, date = F.col("store_id"), F.col("date")
    dow = F.weekday(date) + 1
    planted_zero = (store + F.datediff(date, F.lit("1995-01-01").cast("date"))) % 97 == 0
    new_year = (F.month(date) == 1) & (F.dayofmonth(date) == 1)
    christmas = (F.month(date) == 12) & F.dayofmonth(date).isin(25, 26)
    return days.select(
        "store_id",
        "date",
        F.when(planted_zero, 0.0).otherwise(F.col("day_e4") / F.lit(10000.0)).alias("sales"),
        "customers",
        F.when((dow == 7) & (store % 5 == 0), 0).otherwise(1).alias("open_flag"),
        "promo",
        dow.alias("day_of_week"),
        F.when(new_year, "a").when(christmas, "c").when(store % 7 == 0, "0.0").otherwise("0").alias("state_holiday"),
        F.when(F.month(date).isin(7, 8), 1).otherwise(0).alias("school_holiday"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    letters = F.array(*[F.lit(c) for c in "abcd"])
    competitor, promo2 = k % 6 != 0, k % 2 == 1
    return table(spark, sf_dir, "supplier").select(
        k.alias("store_id"),
        F.element_at(letters, (k % 4 + 1).cast("int")).alias("store_type"),
        F.element_at(letters, (F.col("s_nationkey") % 3 + 1).cast("int")).alias("assortment"),
        F.when(k % 10 != 0, F.col("s_acctbal")).alias("competition_distance"),
        F.when(competitor, 1 + k % 12).cast("int").alias("competition_open_month"),
        F.when(competitor, 1990 + k % 12).cast("int").alias("competition_open_year"),
        (k % 2).cast("int").alias("promo2"),
        F.when(promo2, 1 + (7 * k) % 53).cast("int").alias("promo2_since_week"),
        F.when(promo2, 1994 + k % 6).cast("int").alias("promo2_since_year"),
        F.when(promo2, "Jan,Apr,Jul,Oct").alias("promo_interval"),
    )


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_stores(sales(spark, sf_dir), stores(spark, sf_dir))


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer events: every row carries its kind, so history can be derived from it."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        (F.col("event_type") == "error").alias("is_return"),
        (F.col("event_type") == "purchase").alias("is_purchase"),
        F.col("value").alias("return_amount"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    receipt = (F.col("k") >= 6).cast("int")
    suspicious = (F.col("return_frequency_24h") >= 2) | (
        (F.col("receipt_verified") == 0) & (F.col("return_amount") >= 100)
    )
    rows = derive_history(activity(spark, sf_dir)).where("is_return and days_since_purchase is not null")
    return rows.select(
        "transaction_id",
        (F.col("customer_id") % 50).alias("store_id"),
        "customer_id",
        "ts",
        "return_amount",
        "return_frequency_24h",
        "days_since_purchase",
        receipt.alias("receipt_verified"),
        "customer_tenure_days",
    ).withColumn("label", suspicious.cast("int"))
