"""Business questions: KPIs, trends, drivers, leaderboards, quadrants, forecast and alert views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.money import total, units
from shelfcast.functions.order_stats import exact_quantiles

# Driver columns and their labels.
DRIVERS = {
    "customers": "Store Footfall (Customers)",
    "promo": "Promotional Campaign Active",
    "school_holiday": "School Holiday Period",
    "is_weekend": "Weekend Trading",
    "competition_distance": "Competition Distance (m)",
}


def kpi_overview(days: DataFrame) -> DataFrame:
    return days.agg(
        total(F.col("sales")).alias("total_revenue"),
        F.avg("customers").alias("avg_customers"),
        F.min("date").alias("min_date"),
        F.max("date").alias("max_date"),
    )


def kpi_growth(days: DataFrame) -> DataFrame:
    """Mean sales of the later half of the calendar against the earlier half.

    Days are aggregated first, so the halves are compared on one row per calendar day. The middle
    may fall at noon: compare twice the day number with first + last.
    """
    daily = days.groupBy("date").agg(
        F.sum(units(F.col("sales")).cast("decimal(19,0)")).alias("u"), F.count("sales").alias("n")
    )
    middle = daily.agg((F.unix_date(F.min("date")) + F.unix_date(F.max("date"))).alias("m")).scalar()
    early = F.unix_date("date") * 2 < middle

    def half(condition: Column) -> Column:
        n = F.sum(F.when(condition, F.col("n")))
        mean = F.sum(F.when(condition, F.col("u"))).cast("double") / F.lit(10_000.0) / n
        # an empty half counts as 1
        return F.when(F.count_if(condition) > 0, mean).otherwise(1.0)

    halves = daily.agg(half(early).alias("mean_early"), half(~early).alias("mean_late"))
    change = F.when(
        F.col("mean_early") != 0, (F.col("mean_late") - F.col("mean_early")) * 100 / F.col("mean_early")
    ).otherwise(0.0)
    return halves.withColumn("growth_pct", change)


def period_end(date: Column, frequency: str) -> Column:
    """Last day of the period of ``date``; weeks end on Sunday."""
    if frequency == "daily":
        return date
    if frequency == "weekly":
        return F.date_add(F.date_trunc("week", date).cast("date"), 6)
    if frequency == "monthly":
        return F.last_day(date)
    if frequency == "quarterly":
        return F.last_day(F.add_months(F.date_trunc("quarter", date).cast("date"), 2))
    raise ValueError(f"unknown frequency {frequency!r}")


# Calendar step per frequency.
_STEPS = {"daily": "1 day", "weekly": "7 days", "monthly": "1 month", "quarterly": "3 months"}


def resample_sum(days: DataFrame, frequency: str, amounts: Sequence[str] = ("sales",)) -> DataFrame:
    """Sum per period, labelled by the period's end; periods without rows are there with 0.

    Only the aggregated days (calendar-bounded) feed the spine and the join, never the fact rows.
    """
    daily = days.groupBy("date").agg(
        *[F.sum(units(F.col(c)).cast("decimal(19,0)")).alias(c) for c in amounts]
    )
    sums = daily.groupBy(period_end(F.col("date"), frequency).alias("period_end")).agg(
        *[(F.sum(c).cast("double") / F.lit(10_000.0)).alias(c) for c in amounts]
    )
    step = F.expr(f"interval {_STEPS[frequency]}")
    first = {
        "daily": F.min("date"),
        "weekly": F.date_trunc("week", F.min("date")).cast("date"),
        "monthly": F.date_trunc("month", F.min("date")).cast("date"),
        "quarterly": F.date_trunc("quarter", F.min("date")).cast("date"),
    }[frequency]
    spine = (
        daily.agg(first.alias("first"), F.max("date").alias("last"))
        .where("first is not null")
        .select(F.explode(F.sequence("first", "last", step)).alias("start"))
        .select(period_end(F.col("start"), frequency).alias("period_end"))
    )
    return spine.join(sums, "period_end", "left").select(
        "period_end", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in amounts]
    )


def driver_correlation(days: DataFrame, drivers: dict[str, str] = DRIVERS) -> DataFrame:
    """Pearson r of each present driver with sales in one aggregate, unpivoted and signed."""
    present = [c for c in drivers if c in days.columns]
    sales = F.col("sales")
    one = days.agg(*[F.corr(F.col(c).cast("double"), sales).alias(c) for c in present])
    rows = one.select(
        F.explode(
            F.array(*[F.struct(F.lit(drivers[c]).alias("feature"), F.col(c).alias("correlation")) for c in present])
        ).alias("d")
    ).select("d.*")
    return rows.select(
        "feature",
        "correlation",
        F.when(F.col("correlation") >= 0, "positive").otherwise("negative").alias("direction"),
        F.format_string("%+.3f", "correlation").alias("formatted"),
    ).orderBy(F.asc("correlation"), "feature")


def leaderboard(profiles: DataFrame, stores: DataFrame | None, n: int = 10, top: bool = True) -> DataFrame:
    """Best or worst stores by mean daily sales; the top-k is taken before the attributes are joined."""
    order = F.desc("avg_daily_sales") if top else F.asc("avg_daily_sales")
    ranked = profiles.orderBy(order, "store_id").limit(n)
    columns = ["avg_daily_sales", "sales_cv", "promo_lift_pct"]
    if stores is None:
        return ranked.select("store_id", *columns).orderBy(order, "store_id")
    return (
        ranked.join(stores.select("store_id", "store_type"), "store_id", "left")
        .select("store_id", "store_type", *columns)
        .orderBy(order, "store_id")
    )


def risk_quadrant(profiles: DataFrame) -> DataFrame:
    """Quadrant of each store against the medians of sales and volatility."""
    found = exact_quantiles(profiles, {"avg_daily_sales": [0.5], "sales_cv": [0.5]})
    med_sales, med_cv = found["avg_daily_sales"][0], found["sales_cv"][0]
    busy, volatile = F.col("avg_daily_sales") >= F.lit(med_sales), F.col("sales_cv") >= F.lit(med_cv)
    label = (
        F.when(busy & volatile, "high inventory risk")
        .when(busy, "core revenue")
        .when(volatile, "low volume, volatile")
        .otherwise("low volume, stable")
    )
    return profiles.select(
        "store_id",
        "avg_daily_sales",
        "sales_cv",
        F.lit(med_sales).alias("median_sales"),
        F.lit(med_cv).alias("median_cv"),
        label.alias("quadrant"),
    )


def store_list(days: DataFrame) -> DataFrame:
    return days.select("store_id").distinct().orderBy("store_id")


def cohort(predictions: DataFrame, stores: int | Sequence[int] | None = None) -> DataFrame:
    """Rows of one store, of a list of stores, or of the whole chain."""
    if stores is None:
        return predictions
    wanted = [stores] if isinstance(stores, int) else list(stores)
    return predictions.where(F.col("store_id").isin(wanted))


def forecast_series(predictions: DataFrame, store: int, predicted: str) -> DataFrame:
    return (
        cohort(predictions, store)
        .select("store_id", "date", "actual", F.col(predicted).alias("predicted"))
        .orderBy("date")
    )


def forecast_rollup(
    predictions: DataFrame, predicted: str, frequency: str = "weekly", stores: int | Sequence[int] | None = None
) -> DataFrame:
    rows = cohort(predictions, stores).select("date", "actual", F.col(predicted).alias("predicted"))
    return resample_sum(rows, frequency, ["actual", "predicted"])


def _ends(frequency: str):
    return lambda date: period_end(date, frequency)


def forecast_rollups(
    predictions: DataFrame,
    predicted: str,
    frequencies: Sequence[str],
    scopes: dict[str, int | Sequence[int] | None],
) -> DataFrame:
    """``forecast_rollup`` of several frequencies and scopes (one store, a list, None for all) from one scan.

    The rows are aggregated once to days, with a pair of sums for each scope; what follows works on days. The
    periods of a scope between its first and last day are laid out from the days' own aggregate, so nothing is
    scanned or joined for them.
    """
    amounts = {"actual": F.col("actual"), "predicted": F.col(predicted)}
    wanted = {
        name: F.lit(True) if stores is None else F.col("store_id").isin([stores] if isinstance(stores, int) else list(stores))
        for name, stores in scopes.items()
    }
    daily = predictions.groupBy("date").agg(
        *[
            F.struct(
                F.lit(name).alias("scope"),
                F.count_if(inside).alias("n"),
                *[F.sum(F.when(inside, units(c).cast("decimal(19,0)"))).alias(a) for a, c in amounts.items()],
            ).alias(f"s{k}")
            for k, (name, inside) in enumerate(wanted.items())
        ]
    )
    spans = {f: {"daily": "day", "weekly": "week", "monthly": "month", "quarterly": "quarter"}[f] for f in frequencies}
    cells = F.array(*[F.col(f"s{k}") for k in range(len(wanted))])
    days = daily.select("date", F.explode(cells).alias("s")).where("s.n > 0").select("date", "s.*")
    ends = F.array(
        *[
            F.struct(F.lit(f).alias("frequency"), period_end(F.col("date"), f).alias("period_end"))
            for f in frequencies
        ]
    )
    periods = (
        days.select("scope", "date", *amounts, F.explode(ends).alias("p"))
        .groupBy("scope", "p.frequency", "p.period_end")
        .agg(F.min("date").alias("first"), F.max("date").alias("last"), *[F.sum(a).alias(a) for a in amounts])
    )
    # the calendar bounds the periods of a scope
    kept = F.struct("period_end", F.struct(*amounts).alias("sums"))
    ranges = periods.groupBy("scope", "frequency").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.map_from_entries(F.collect_list(kept)).alias("sums")
    )
    spine = F.lit(None).cast("array<date>")
    for f, unit in spans.items():
        start = F.date_trunc(unit, F.col("first")).cast("date")
        dates = F.transform(F.sequence(start, F.col("last"), F.expr(f"interval {_STEPS[f]}")), _ends(f))
        spine = F.when(F.col("frequency") == f, dates).otherwise(spine)
    rows = ranges.where("first is not null").select("frequency", "scope", "sums", F.explode(spine).alias("period_end"))
    rows = rows.withColumn("sums", F.try_element_at("sums", "period_end"))
    return rows.select(
        "frequency",
        "scope",
        "period_end",
        *[F.coalesce(F.col(f"sums.{a}").cast("double") / F.lit(10_000.0), F.lit(0.0)).alias(a) for a in amounts],
    )


def forecast_variance(predictions: DataFrame, predicted: str, stores=None) -> DataFrame:
    sums = cohort(predictions, stores).agg(
        F.coalesce(total(F.col("actual")), F.lit(0.0)).alias("total_actual"),
        F.coalesce(total(F.col(predicted)), F.lit(0.0)).alias("total_predicted"),
    )
    delta = F.when(
        F.col("total_actual") != 0, (F.col("total_predicted") - F.col("total_actual")) * 100 / F.col("total_actual")
    ).otherwise(0.0)
    return sums.withColumn("variance_pct", delta)


def alert_kpis(alerts: DataFrame) -> DataFrame:
    high = F.when(F.col("severity") == "high", F.col("return_amount"))
    return alerts.agg(
        F.count("*").alias("reviewed"),
        F.count_if("flagged_p95").alias("flagged_p95"),
        F.coalesce(total(high), F.lit(0.0)).alias("high_exposure"),
    )


def _tier(score: Column, p95: float, p99: float) -> Column:
    # display tiers include their lower bound; flags (strictly above) are a separate rule
    return F.when(score < F.lit(p95), "normal").when(score < F.lit(p99), "elevated").otherwise("critical")


def risk_tiers(alerts: DataFrame, p95: float, p99: float, score: str = "score") -> DataFrame:
    """Count and share per tier; all three tiers are listed even if empty."""
    tier = _tier(F.col(score), p95, p99)
    counts = alerts.agg(
        F.count("*").alias("all"),
        *[F.count_if(tier == t).alias(t) for t in ("normal", "elevated", "critical")],
    )
    cells = F.array(*[F.struct(F.lit(t).alias("tier"), F.col(t).alias("n")) for t in ("normal", "elevated", "critical")])
    return counts.select("all", F.explode(cells).alias("c")).select(
        "c.tier", "c.n", F.coalesce(F.try_divide(F.col("c.n") * 100.0, F.col("all")), F.lit(0.0)).alias("share_pct")
    )


# Histogram bins per tier.
TIER_BINS = {"normal": 45, "elevated": 15, "critical": 10}


def score_histogram(alerts: DataFrame, p95: float, p99: float, score: str = "score") -> DataFrame:
    """Equal-width histogram inside each tier; two map-side aggregates, three rows in between."""
    tiered = alerts.select(_tier(F.col(score), p95, p99).alias("tier"), F.col(score).alias("s")).where("s is not null")
    spans = {r["tier"]: r for r in tiered.groupBy("tier").agg(F.min("s").alias("lo"), F.max("s").alias("hi")).collect()}
    bucket = F.lit(1)
    start = F.lit(None).cast("double")
    for tier, bins in TIER_BINS.items():
        if tier not in spans:
            continue
        lo, hi = spans[tier]["lo"], spans[tier]["hi"]
        width = (hi - lo) / bins
        inside = F.col("tier") == tier
        if width > 0:
            # the largest value belongs to the last bin
            index = F.least(F.floor((F.col("s") - F.lit(lo)) / F.lit(width)) + 1, F.lit(bins))
            bucket = F.when(inside, index).otherwise(bucket)
        start = F.when(inside, F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).otherwise(start)
    counted = tiered.withColumn("bin", bucket.cast("int")).groupBy("tier", "bin").agg(F.count("*").alias("n"))
    return counted.select("tier", "bin", start.alias("bin_start"), "n")


def alert_feed(alerts: DataFrame, severity: str = "all", n: int = 250, score: str = "score") -> DataFrame:
    """The ``n`` highest scores of the chosen severities (all, high, medium and high)."""
    kept = {"all": None, "high": ["high"], "medium_high": ["medium", "high"]}[severity]
    rows = alerts if kept is None else alerts.where(F.col("severity").isin(kept))
    return rows.orderBy(F.desc(score), "transaction_id").limit(n)
