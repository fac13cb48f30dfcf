import datetime as dt

import pytest

from shelfcast.operators import bi


def frame(spark, rows):
    return spark.createDataFrame(rows, "store_id int, date date, sales double")


def test_resample_fills_empty_periods(spark):
    df = frame(spark, [(1, dt.date(2020, 1, 1), 1.5), (2, dt.date(2020, 1, 1), 2.0), (1, dt.date(2020, 1, 20), 4.0)])
    weekly = [(r["period_end"], r["sales"]) for r in bi.resample_sum(df, "weekly").orderBy("period_end").collect()]
    assert weekly == [
        (dt.date(2020, 1, 5), 3.5), (dt.date(2020, 1, 12), 0.0), (dt.date(2020, 1, 19), 0.0), (dt.date(2020, 1, 26), 4.0),
    ]
    assert bi.resample_sum(df, "daily").count() == 20
    df = frame(spark, [(1, dt.date(2020, 1, 31), 1.0), (1, dt.date(2020, 3, 1), 2.0)])
    months = [(r["period_end"], r["sales"]) for r in bi.resample_sum(df, "monthly").orderBy("period_end").collect()]
    assert months == [(dt.date(2020, 1, 31), 1.0), (dt.date(2020, 2, 29), 0.0), (dt.date(2020, 3, 31), 2.0)]
    quarter = bi.resample_sum(df, "quarterly").collect()
    assert [(r["period_end"], r["sales"]) for r in quarter] == [(dt.date(2020, 3, 31), 3.0)]
    with pytest.raises(ValueError):
        bi.resample_sum(df, "yearly")


def test_growth_middle_at_noon(spark):
    # four days: the middle is 2.5 days in, two days on each side
    df = frame(spark, [(1, dt.date(2020, 1, d), s) for d, s in ((1, 1.0), (2, 3.0), (3, 6.0), (4, 2.0))])
    row = bi.kpi_growth(df).first()
    assert (row["mean_early"], row["mean_late"], row["growth_pct"]) == (2.0, 4.0, 100.0)
    one = bi.kpi_growth(frame(spark, [(1, dt.date(2020, 1, 1), 8.0)])).first()
    assert (one["mean_early"], one["mean_late"]) == (1.0, 8.0)


def test_leaderboard_and_quadrant(spark):
    profiles = spark.createDataFrame(
        [(1, 10.0, 0.5, 1.0), (2, 20.0, 0.1, 2.0), (3, 20.0, 0.9, 3.0), (4, 5.0, 0.2, 0.0)],
        "store_id int, avg_daily_sales double, sales_cv double, promo_lift_pct double",
    )
    stores = spark.createDataFrame([(1, "a"), (2, "b")], "store_id int, store_type string")
    assert [r["store_id"] for r in bi.leaderboard(profiles, stores, 2).collect()] == [2, 3]
    assert [r["store_id"] for r in bi.leaderboard(profiles, None, 2, top=False).collect()] == [4, 1]
    got = {r["store_id"]: r["quadrant"] for r in bi.risk_quadrant(profiles).collect()}
    assert got == {1: "low volume, volatile", 2: "core revenue", 3: "high inventory risk", 4: "low volume, stable"}


def test_tiers_histogram_and_feed(spark):
    rows = [(i, float(i), "high" if i >= 99 else "medium" if i >= 95 else "low") for i in range(100)]
    df = spark.createDataFrame(rows, "transaction_id bigint, score double, severity string")
    tiers = {r["tier"]: (r["n"], r["share_pct"]) for r in bi.risk_tiers(df, 95.0, 99.0).collect()}
    assert tiers == {"normal": (95, 95.0), "elevated": (4, 4.0), "critical": (1, 1.0)}
    bins = bi.score_histogram(df, 95.0, 99.0).collect()
    assert sum(r["n"] for r in bins) == 100
    assert max(r["bin"] for r in bins if r["tier"] == "normal") == 45
    assert [r["bin"] for r in bins if r["tier"] == "critical"] == [1]
    empty = {r["tier"]: r["n"] for r in bi.risk_tiers(df.limit(0), 1.0, 2.0).collect()}
    assert empty == {"normal": 0, "elevated": 0, "critical": 0}
    assert [r["transaction_id"] for r in bi.alert_feed(df, "medium_high", 3).collect()] == [99, 98, 97]
    assert bi.alert_feed(df, "high").count() == 1


def test_forecast_views(spark):
    df = spark.createDataFrame(
        [(1, dt.date(2020, 1, 1), 10.0, 12.0), (2, dt.date(2020, 1, 1), 30.0, 28.0), (1, dt.date(2020, 1, 2), 0.0, 1.0)],
        "store_id int, date date, actual double, p double",
    )
    assert bi.forecast_variance(df, "p").first()["variance_pct"] == pytest.approx(2.5)
    assert bi.forecast_variance(df, "p", 9).first()["variance_pct"] == 0.0
    assert bi.cohort(df, [1]).count() == 2
    assert [r["predicted"] for r in bi.forecast_series(df, 1, "p").collect()] == [12.0, 1.0]
    assert bi.forecast_rollup(df, "p", "weekly", [1, 2]).first()["predicted"] == 41.0


def test_drivers_sorted_and_signed(spark):
    df = spark.createDataFrame([(1, 5.0, 10.0), (2, 4.0, 20.0), (3, 3.5, 30.0)], "customers int, promo double, sales double")
    rows = bi.driver_correlation(df).collect()
    assert [r["direction"] for r in rows] == ["negative", "positive"]
    assert rows[1]["formatted"] == "+1.000"
