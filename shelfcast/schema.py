"""Canonical column names and types; sources are renamed to these once, at ingestion."""

from __future__ import annotations

from pyspark.sql import types as T

SALES_SCHEMA = T.StructType(
    [
        T.StructField("store_id", T.LongType()),
        T.StructField("date", T.DateType()),
        T.StructField("sales", T.DoubleType()),
        T.StructField("customers", T.LongType()),
        T.StructField("open_flag", T.IntegerType()),
        T.StructField("promo", T.IntegerType()),
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("state_holiday", T.StringType()),
        T.StructField("school_holiday", T.IntegerType()),
    ]
)

STORE_SCHEMA = T.StructType(
    [
        T.StructField("store_id", T.LongType()),
        T.StructField("store_type", T.StringType()),
        T.StructField("assortment", T.StringType()),
        T.StructField("competition_distance", T.DoubleType()),
        T.StructField("competition_open_month", T.IntegerType()),
        T.StructField("competition_open_year", T.IntegerType()),
        T.StructField("promo2", T.IntegerType()),
        T.StructField("promo2_since_week", T.IntegerType()),
        T.StructField("promo2_since_year", T.IntegerType()),
        T.StructField("promo_interval", T.StringType()),
    ]
)

RETURNS_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("store_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("return_amount", T.DoubleType()),
        T.StructField("return_frequency_24h", T.LongType()),
        T.StructField("days_since_purchase", T.LongType()),
        T.StructField("receipt_verified", T.IntegerType()),
        T.StructField("customer_tenure_days", T.LongType()),
        T.StructField("label", T.IntegerType()),
    ]
)

# The source headers of the public retail data set, per canonical name.
SOURCE_HEADERS = {
    "date": "Date",
    "store_id": "Store",
    "sales": "Sales",
    "customers": "Customers",
    "open_flag": "Open",
    "promo": "Promo",
    "day_of_week": "DayOfWeek",
    "state_holiday": "StateHoliday",
    "school_holiday": "SchoolHoliday",
    "store_type": "StoreType",
    "assortment": "Assortment",
    "competition_distance": "CompetitionDistance",
    "competition_open_month": "CompetitionOpenSinceMonth",
    "competition_open_year": "CompetitionOpenSinceYear",
    "promo2": "Promo2",
    "promo2_since_week": "Promo2SinceWeek",
    "promo2_since_year": "Promo2SinceYear",
    "promo_interval": "PromoInterval",
}

# Optional in a sales file: everything else must be there.
OPTIONAL_SALES = {"customers"}

# The target and the columns that must never reach a forecast model, the lags and windows
# of the panel, the features of store profiles and of return transactions.
TARGET = "sales"
NOT_FEATURES = ("sales", "customers", "open_flag", "is_zero_sales_anomaly", "date", "promo_interval")

LAGS = (7, 14, 21, 30)
WINDOWS = (7, 14, 30)
VALIDATION_WEEKS = 6

PROFILE_FEATURES = (
    "avg_daily_sales",
    "sales_cv",
    "avg_daily_customers",
    "promo_lift_pct",
    "promo_day_share",
)

RETURN_FEATURES = (
    "return_amount_log",
    "return_frequency_24h",
    "days_since_purchase",
    "receipt_verified",
    "customer_tenure_days",
)

_WHOLE = (
    "year", "month", "day", "quarter", "week_of_year", "is_weekend", "is_promo", "is_zero_sales_anomaly",
    "has_competition_open_date",
)


def column_type(name: str) -> T.DataType:
    """The type of a panel or source column by its name; text where the name says nothing."""
    headers = {SOURCE_HEADERS[f.name]: f.dataType for f in (*SALES_SCHEMA, *STORE_SCHEMA)}
    known = {f.name: f.dataType for f in (*SALES_SCHEMA, *STORE_SCHEMA, *RETURNS_SCHEMA)}
    if name in _WHOLE:
        return T.IntegerType()
    if name.startswith(("sales_lag_", "sales_rolling_", "predicted_")) or name.endswith(("_since_competition", "_since_promo2")):
        return T.DoubleType()
    return known.get(name, headers.get(name, T.StringType()))
