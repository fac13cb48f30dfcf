import datetime as dt

import numpy as np
import pandas as pd
import pytest
from conftest import make_days
from pyspark.sql import functions as F

from shelfcast.operators import clean, features, split
from shelfcast.sources import tables


def test_open_days_and_anomaly_flag(spark):
    df = spark.createDataFrame([(1, 10.0), (1, 0.0), (0, 5.0), (None, 1.0), (1, None)], "open_flag int, sales double")
    rows = clean.open_days(df).orderBy("sales").collect()
    assert [(r["sales"], r["is_zero_sales_anomaly"]) for r in rows] == [(None, 0), (0.0, 1), (10.0, 0)]


def test_impute_policy(spark):
    df = spark.createDataFrame(
        [
            (1, 10.0, 3, 2000, None, None, None, "0.0"),
            (1, 10.0, 3, 2000, None, None, None, "0"),
            (2, None, None, 2001, 5, 2010, "Jan", None),
            (3, 40.0, 4, None, 5, 2010, "Jan", "a"),
        ],
        "store_id int, competition_distance double, competition_open_month int, competition_open_year int,"
        "promo2_since_week int, promo2_since_year int, promo_interval string, state_holiday string",
    )
    rows = clean.impute(df).orderBy("store_id").collect()
    # median over rows (10, 10, 40), not over stores
    assert rows[2]["competition_distance"] == 10.0
    assert [r["has_competition_open_date"] for r in rows] == [1, 1, 0, 0]
    assert [r["state_holiday"] for r in rows] == ["0", "0", "nan", "a"]
    assert rows[0]["promo_interval"] == "" and rows[0]["promo2_since_week"] == 0
    assert rows[3]["competition_open_year"] == 0


def test_history_is_positional_and_excludes_the_row(spark):
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=3 * i) for i in range(10)]
    df = spark.createDataFrame([(1, d, float(i + 1)) for i, d in enumerate(days)], "store_id int, date date, sales double")
    rows = features.history_features(df, lags=(2,), windows=(3,)).orderBy("date").collect()
    assert [r["sales_lag_2"] for r in rows[:4]] == [None, None, 1.0, 2.0]
    assert [r["sales_rolling_mean_3"] for r in rows[:5]] == [None, 1.0, 1.5, 2.0, 3.0]
    assert rows[1]["sales_rolling_std_3"] is None
    assert rows[4]["sales_rolling_std_3"] == pytest.approx(1.0)


def test_history_matches_pandas(spark):
    df = make_days(spark, stores=3, days=80)
    got = features.history_features(df.select("store_id", "date", "sales")).toPandas().sort_values(["store_id", "date"])
    g = df.toPandas().sort_values(["store_id", "date"]).groupby("store_id")["sales"]
    for n in (7, 14, 21, 30):
        np.testing.assert_array_equal(got[f"sales_lag_{n}"].to_numpy(), g.shift(n).to_numpy())
    for n in (7, 14, 30):
        mean = g.transform(lambda s: s.shift(1).rolling(n, min_periods=1).mean())
        std = g.transform(lambda s: s.shift(1).rolling(n, min_periods=1).std())
        np.testing.assert_allclose(got[f"sales_rolling_mean_{n}"].to_numpy(), mean.to_numpy(), rtol=1e-12)
        np.testing.assert_allclose(got[f"sales_rolling_std_{n}"].to_numpy(), std.to_numpy(), rtol=1e-9)


def test_tasks_of_segmented_history_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(features, "_TASK_ROWS", 10)
    df = make_days(spark, stores=2, days=150)
    cut = features.segmented_history_features(df, segment_rows=40)
    assert cut.rdd.getNumPartitions() == 30  # of 300 rows; whatever the session's shuffle partitions are
    assert cut.exceptAll(features.history_features(df)).count() == 0 and cut.count() == 300


def test_segmented_history_equals_plain_for_a_dominant_store(spark):
    rng = np.random.default_rng(0)
    rows = [(1, dt.date(2000, 1, 1) + dt.timedelta(days=i), float(rng.integers(1, 999))) for i in range(700)]
    rows += [(s, dt.date(2000, 1, 1) + dt.timedelta(days=5 * i), float(i)) for s in (2, 3) for i in range(20)]
    df = spark.createDataFrame(rows, "store_id int, date date, sales double")
    plain = features.history_features(df)
    cut = features.segmented_history_features(df, segment_rows=40)
    assert cut.columns == plain.columns and cut.count() == len(rows)
    assert plain.exceptAll(cut).count() == 0
    with pytest.raises(ValueError):
        features.segmented_history_features(df, segment_rows=30)


def test_elapsed_edges(spark):
    rows = [
        (dt.date(2020, 5, 10), 3, 2019, 1, 2020),
        (dt.date(2020, 5, 10), 6, 2020, 53, 1997),
        (dt.date(2020, 5, 10), 0, 2019, 0, 2019),
        (dt.date(2020, 5, 10), 13, 2019, 54, 2019),
        (dt.date(2020, 5, 10), 3, 0, 5, 0),
    ]
    df = spark.createDataFrame(
        rows,
        "date date, competition_open_month int, competition_open_year int, promo2_since_week int, promo2_since_year int",
    )
    got = features.elapsed_features(df).collect()
    assert [r["months_since_competition"] for r in got] == [14.0, 0.0, 0.0, 0.0, 0.0]
    monday = dt.date(2019, 12, 30)
    assert got[0]["weeks_since_promo2"] == pytest.approx((dt.date(2020, 5, 10) - monday).days / 7)
    # week 53 of a 52-week year is the first week of the next
    assert got[1]["weeks_since_promo2"] == pytest.approx((dt.date(2020, 5, 10) - dt.date(1997, 12, 29)).days / 7)
    assert [r["weeks_since_promo2"] for r in got[2:]] == [0.0, 0.0, 0.0]


def test_calendar(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 3), 7, 1)], "date date, day_of_week int, promo int")
    r = features.calendar_features(df).first()
    assert (r["year"], r["month"], r["day"], r["quarter"], r["week_of_year"], r["is_weekend"], r["is_promo"]) == (
        2021, 1, 3, 1, 53, 1, 1,
    )


def test_holdout_split_is_strict(spark):
    df = make_days(spark, stores=2, days=60)
    train, val = split.holdout_split(df, weeks=2)
    last_train = train.agg(F.max("date")).first()[0]
    first_val = val.agg(F.min("date")).first()[0]
    assert (first_val - last_train).days == 1
    assert val.count() == 28 and train.count() + val.count() == 120


def test_temporal_folds_match_row_order(spark):
    df = make_days(spark, stores=3, days=31).select("store_id", "date")
    folds = split.temporal_folds(df, 3).toPandas().sort_values(["date", "store_id"])["fold"].to_numpy()
    n = 93
    size = n // 4
    expected = np.repeat([0, 1, 2, 3], [n - 3 * size, size, size, size])
    np.testing.assert_array_equal(folds, expected)


def test_train_monitor_cuts_at_the_exact_row(spark):
    rows = [(i, dt.datetime(2020, 1, 1) + dt.timedelta(minutes=i // 4)) for i in range(101)]
    df = spark.createDataFrame(rows, "transaction_id bigint, ts timestamp")
    out = split.train_monitor(df, 0.7).toPandas()
    assert out["is_train"].sum() == 70
    assert out.loc[out["is_train"], "transaction_id"].max() == 69


def test_csv_ingest(spark, tmp_path):
    (tmp_path / "train.csv").write_text(
        "Store,DayOfWeek,Date,Sales,Customers,Open,Promo,StateHoliday,SchoolHoliday\n"
        "1,5,2015-07-31,5263,555,1,1,0,1\n2,5,2015-07-31,6064,625,1,1,0,1\n9,5,2015-07-31,1,1,1,,a,0\n"
    )
    header = (
        "Store,StoreType,Assortment,CompetitionDistance,CompetitionOpenSinceMonth,CompetitionOpenSinceYear,"
        "Promo2,Promo2SinceWeek,Promo2SinceYear,PromoInterval\n"
    )
    (tmp_path / "store.csv").write_text(header + '1,c,a,1270,9.0,2008,0,,,\n2,a,a,570,11,2007,1,13,2010,"Jan,Apr,Jul,Oct"\n')
    sales = tables.read_sales(spark, str(tmp_path / "train.csv"))
    stores = tables.read_stores(spark, str(tmp_path / "store.csv"))
    rows = tables.with_stores(sales, stores).orderBy("store_id").collect()
    assert [r["store_type"] for r in rows] == ["c", "a", None]
    assert rows[0]["competition_open_month"] == 9 and rows[0]["promo_interval"] is None
    assert rows[0]["date"] == dt.date(2015, 7, 31) and rows[2]["promo"] is None
    doubled = stores.unionByName(stores)
    with pytest.raises(Exception, match="store listed more than once"):
        tables.with_stores(sales, doubled).collect()
    (tmp_path / "bad.csv").write_text("Store,Date\n1,2015-07-31\n")
    with pytest.raises(ValueError, match="Sales"):
        tables.read_sales(spark, str(tmp_path / "bad.csv"))


def test_mapping_and_table_loader(spark, tmp_path):
    config = tmp_path / "map.yaml"
    config.write_text("columns:\n  sales: Revenue\n  unknown: X\n")
    assert tables.column_mapping(str(config))["sales"] == "Revenue"
    assert tables.column_mapping(str(config))["date"] == "Date"
    assert "unknown" not in tables.column_mapping(str(config))
    assert tables.column_mapping(str(tmp_path / "none.yaml")) == tables.column_mapping()
    assert tables.load_table(spark, str(tmp_path), "nothing") is None
    (tmp_path / "t.csv").write_text("Date,x\n2020-01-02,1\n")
    assert tables.load_table(spark, str(tmp_path), "t").first()["Date"] == dt.date(2020, 1, 2)
    spark.range(3).write.parquet(str(tmp_path / "t.parquet"))
    assert tables.load_table(spark, str(tmp_path), "t").count() == 3


def test_nan_becomes_null(spark):
    df = spark.createDataFrame(pd.DataFrame({c: [1.0, float("nan")] for c in tables.SOURCE_HEADERS.values()}))
    out = tables.canonical(df, tables.STORE_SCHEMA, tables.column_mapping())
    assert out.where("competition_distance is null").count() == 1


def test_values_that_do_not_parse_are_quarantined(spark, tmp_path):
    (tmp_path / "train.csv").write_text(
        "Store,DayOfWeek,Date,Sales,Customers,Open,Promo,StateHoliday,SchoolHoliday\n"
        "1,1,2015-01-05,100.5,9.0,1,0,0,0\n"
        "2,2,not a day,abc,5,1,0,0,0\n"
        "3,3,2015-01-07,7,,1,NaN,a, \n"
        "4,4,2015-01-08,7,4.5,1,99999999999,a,0\n"
    )
    mapping = tables.column_mapping()
    raw = tables.read_raw(spark, str(tmp_path / "train.csv"))
    good = tables.read_sales(spark, str(tmp_path / "train.csv"))
    assert [(r["store_id"], r["customers"], r["promo"], r["school_holiday"]) for r in good.orderBy("store_id").collect()] == [
        (1, 9, 0, 0),
        (3, None, None, None),
    ]
    rejects = tables.quarantined(raw, tables.SALES_SCHEMA, mapping, tables.OPTIONAL_SALES)
    found = {(r["column"], r["value"], r["reason"]) for r in rejects.collect()}
    assert found == {
        ("date", "not a day", "not a date"),
        ("sales", "abc", "not a double"),
        ("customers", "4.5", "not a bigint"),
        ("promo", "99999999999", "not a int"),
    }
    assert {r["column"]: r["n"] for r in tables.failure_counts(rejects).collect()} == dict.fromkeys(("date", "sales", "customers", "promo"), 1)
    assert good.count() + rejects.select("row").distinct().count() == raw.count()
    assert all('"Store":"2"' in r["row"] for r in rejects.where("value = 'abc'").collect())


def test_csv_types_come_from_names_without_a_pass_over_the_data(spark, tmp_path):
    (tmp_path / "p.csv").write_text("store_id,date,sales,sales_lag_7,promo,note\n1,2020-01-02,5,,1,007\n")
    table = tables.load_table(spark, str(tmp_path), "p")
    assert dict(table.dtypes) == {
        "store_id": "bigint", "date": "date", "sales": "double", "sales_lag_7": "double", "promo": "int", "note": "string",
    }
    row = table.first()
    assert (row["date"], row["sales"], row["sales_lag_7"], row["note"]) == (dt.date(2020, 1, 2), 5.0, None, "007")


def test_the_written_panel_lies_by_year_and_is_pruned(spark, tmp_path):
    from shelfcast.sources import reports

    days = [(1, dt.date(y, 6, 1), y, float(y)) for y in (2013, 2014, 2015)]
    panel = spark.createDataFrame(days, "store_id bigint, date date, year int, sales double")
    reports.write_panel(panel.where("year < 2015"), panel.where("year = 2015"), str(tmp_path))
    path = str(tmp_path / "train_processed.parquet")
    late = tables.read_panel(spark, path, first=dt.date(2014, 3, 1))
    text = late._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in text and "(year#" in text.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert [r["year"] for r in late.collect()] == [2014]
    assert sum("year=2014" in f for f in late.inputFiles()) >= 1
    assert tables.read_panel(spark, path, last=dt.date(2013, 12, 31)).count() == 1
    again = panel.where("year = 2014").withColumn("sales", F.lit(1.0))
    reports.write_panel(again, panel.limit(0), str(tmp_path), replace=False)
    assert {r["year"]: r["sales"] for r in spark.read.parquet(path).collect()} == {2013: 2013.0, 2014: 1.0}
    reports.write_panel(again, panel.limit(0), str(tmp_path))
    assert spark.read.parquet(path).count() == 1
