"""The shape of physical plans: shuffles, pushdown, no Python in relational work."""

import importlib
import re

import pytest

from shelfcast.operators import clean, features
from shelfcast.plans.catalog import QUERIES
from shelfcast.plans.oracles import ORACLES
from shelfcast.sources import tpch


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_history_has_one_exchange_and_one_window(spark):
    df = spark.createDataFrame([(1, "2020-01-01", 1.0)], "store_id int, d string, sales double").selectExpr(
        "store_id", "to_date(d) as date", "sales"
    )
    text = plan(features.history_features(df))
    assert text.count("Exchange") == 1 and len(re.findall(r"\bWindow \[", text)) == 1 and text.count("Sort ") == 1


def test_store_join_is_broadcast_while_small_and_shuffled_when_not(spark, data_dir):
    assert "BroadcastHashJoin" in plan(tpch.panel(spark, data_dir))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(tpch.panel(spark, data_dir))
        assert "Broadcast" not in text and "SortMergeJoin" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scan_reads_only_needed_columns(spark, data_dir):
    text = plan(QUERIES["resample_weekly"](spark, data_dir))
    read = [s for s in re.findall(r"ReadSchema: struct<([^>]*)>", text)]
    assert read and all("l_orderkey" not in r and "l_quantity" not in r for r in read)


@pytest.mark.parametrize("name", ["prepare_features", "store_profiles", "kpi_growth", "derive_returns", "eval_metrics"])
def test_relational_queries_stay_in_the_jvm(spark, data_dir, name):
    text = plan(QUERIES[name](spark, data_dir))
    assert "Python" not in text and "ArrowEval" not in text and "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_no_window_without_partition_on_fact_rows(spark, data_dir):
    from shelfcast.operators.split import temporal_folds, train_monitor

    for df in (temporal_folds(clean.open_days(tpch.sales(spark, data_dir))), train_monitor(tpch.returns(spark, data_dir))):
        assert not re.search(r"windowspecdefinition\(\w+#\d+L? ASC", plan(df))


def test_rollups_scan_their_input_once(spark, data_dir):
    # one scan of the rows and one for the cutoff date
    assert plan(QUERIES["forecast_rollup"](spark, data_dir)).count("FileScan parquet") == 2


def test_contract():
    entry = importlib.import_module("__spark_entry__")
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert QUERIES.keys() <= entry.queries().keys() and ORACLES.items() <= entry.oracle_sql().items()
