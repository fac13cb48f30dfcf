"""Rows with NULL keys are kept; staging and reading without surprises."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from shelfcast import session
from shelfcast.operators import evaluate, features, split
from shelfcast.operators.returns import derive_history
from shelfcast.schema import STORE_SCHEMA
from shelfcast.sources import reports, tables


def test_rows_without_time_get_a_side(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(i, None if i % 7 == 0 else start + dt.timedelta(hours=i)) for i in range(20)]
    df = spark.createDataFrame([*rows, (None, None)], "transaction_id long, ts timestamp")
    got = split.train_monitor(df, 0.5).collect()
    assert len(got) == 21 and all(r.is_train is not None for r in got)
    assert sum(r.is_train for r in got) == 10
    assert not any(r.is_train for r in got if r.ts is None)


def test_folds_keep_rows_without_date_or_store(spark):
    rows = [(s, dt.date(2024, 1, 1) + dt.timedelta(days=d)) for s in (1, None) for d in range(10)] + [(2, None)]
    folded = split.temporal_folds(spark.createDataFrame(rows, "store_id long, date date"), 3)
    assert folded.where("fold is not null").count() == 21
    assert folded.where("date is null").first().fold == 3


def test_history_keeps_rows_without_customer_or_time(spark):
    at = dt.datetime(2024, 1, 1)
    rows = [(1, None, at, True, False), (2, None, at + dt.timedelta(hours=1), True, True), (3, 7, None, True, True)]
    df = spark.createDataFrame(rows, "id int, customer_id int, ts timestamp, is_return boolean, is_purchase boolean")
    got = {r.id: (r.return_frequency_24h, r.days_since_purchase) for r in derive_history(df).collect()}
    assert set(got) == {1, 2, 3} and got[1] == (0, None) and got[2] == (1, None)


def test_segmented_history_keeps_rows_without_date(spark):
    rows = [(1, dt.date(2024, 1, 1) + dt.timedelta(days=i), float(i)) for i in range(60)]
    rows += [(1, None, 5.0), (1, None, 3.0), (None, None, 1.0)]
    df = spark.createDataFrame(rows, "store_id int, date date, sales double")
    plain, cut = features.history_features(df), features.segmented_history_features(df, segment_rows=40)
    assert cut.count() == plain.count() == 63 and plain.exceptAll(cut).count() == 0


def test_staging_without_a_shared_folder_writes_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_dir", lambda _: None)
    kept = session.stage(spark.range(5), "x")
    assert kept.storageLevel.useMemory and list(kept.inputFiles()) == [] and kept.count() == 5
    kept.unpersist()
    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    assert session.stage(spark.range(5), "x").inputFiles() and list(tmp_path.iterdir())


def test_not_a_number_in_text_is_null(spark):
    names = [f.name for f in STORE_SCHEMA]
    df = spark.createDataFrame([("1", *["NaN"] * (len(names) - 1))], names)
    row = tables.canonical(df, STORE_SCHEMA, {n: n for n in names}).first()
    assert row.store_id == 1 and row.competition_distance is None and row.promo2 is None


def test_flat_mapping_file(tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "flat.yaml").write_text("sales: Turnover\nunknown: x\n")
    (tmp_path / "nested.yaml").write_text("columns:\n  sales: Turnover\n")
    for name in ("flat", "nested"):
        got = tables.column_mapping(str(tmp_path / f"{name}.yaml"))
        assert got["sales"] == "Turnover" and got["date"] == "Date" and "unknown" not in got


def test_broken_report_is_none(spark, tmp_path):
    (tmp_path / "good.json").write_text(json.dumps({"a": 1}) + "\n" + json.dumps({"a": 2}) + "\n")
    (tmp_path / "bad.json").write_text(json.dumps({"a": 1}) + "\n{broken\n")
    assert reports.read_report(spark, str(tmp_path / "good.json")).count() == 2
    assert reports.read_report(spark, str(tmp_path / "bad.json")) is None


def test_metrics_leave_out_rows_without_prediction(spark):
    rows = [(10.0, 8.0, None), (0.0, 1.0, None), (5.0, None, None)]
    wide = spark.createDataFrame(rows, "actual double, a double, b double")
    got = evaluate.evaluate_models(wide, {"m": "a", "none": "b"}).collect()
    assert [(r.model_name, r.mae, r.rows_excluded_zero_sales) for r in got] == [("m", 1.5, 1)]


def test_one_pass_split_equals_the_two_parts(spark):
    rows = [(1, dt.date(2024, 1, 1) + dt.timedelta(days=i)) for i in range(100)]
    df = spark.createDataFrame(rows, "store_id int, date date")
    train, val = split.holdout_split(df)
    parts = split.with_part(df)
    assert parts.where("part = 'train'").drop("part").exceptAll(train).count() == 0
    assert parts.where(F.col("part") == "val").count() == val.count() == 42
