import datetime as dt
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import fraud
from shelfcast.operators.returns import derive_history
from shelfcast.operators.split import train_monitor
from shelfcast.plans import pipelines
from shelfcast.streaming.alerts import deliver_alerts, score_stream, write_alerts
from shelfcast.streaming.frequency import return_frequency_stream


def make_returns(spark, n=500, bad=30, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        odd = i % (n // bad) == 5
        rows.append(
            (
                i,
                int(rng.integers(1, 50)),
                int(rng.integers(1, 99)),
                dt.datetime(2024, 1, 1) + dt.timedelta(minutes=10 * i),
                float(rng.lognormal(5.3 if odd else 3.0, 0.5)),
                int(rng.integers(3, 9) if odd else rng.integers(0, 2)),
                int(rng.integers(1, 31)),
                int(rng.random() < (0.2 if odd else 0.94)),
                int(rng.integers(60, 3000)),
                int(odd),
            )
        )
    return spark.createDataFrame(
        rows,
        "transaction_id bigint, store_id bigint, customer_id bigint, ts timestamp, return_amount double,"
        "return_frequency_24h bigint, days_since_purchase bigint, receipt_verified int,"
        "customer_tenure_days bigint, label int",
    )


@pytest.mark.parametrize("step, count", [(3_600_000_000, 240), (1_000_000, 172_900), (250_000, 700_000)])
def test_history_matches_brute_force_with_a_dominant_customer(spark, step, count):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(400):
        customer = 1 if rng.random() < 0.5 else int(rng.integers(2, 8))
        # coarse instants: simultaneous events and exact 24-hour gaps occur
        at = dt.datetime(2024, 1, 1) + dt.timedelta(microseconds=step * int(rng.integers(0, count)))
        kind = rng.choice(["return", "purchase", "view"])
        rows.append((i, customer, at, bool(kind == "return"), bool(kind == "purchase")))
    df = spark.createDataFrame(rows, "id int, customer_id int, ts timestamp, is_return boolean, is_purchase boolean")
    got = {r["id"]: r for r in derive_history(df).collect()}
    assert len(got) == 400
    day = dt.timedelta(days=1)
    for i, c, t, _, _ in rows:
        own = [r for r in rows if r[1] == c]
        frequency = sum(r[3] and t - day <= r[2] < t for r in own)
        bought = [r[2] for r in own if r[4] and r[2] < t]
        since = (t - max(bought)) // day if bought else None
        tenure = (t - min(r[2] for r in own)) // day
        r = got[i]
        assert (r["return_frequency_24h"], r["days_since_purchase"], r["customer_tenure_days"]) == (frequency, since, tenure)


def test_features_exclude_the_label(spark):
    feats = fraud.return_features(make_returns(spark))
    assert feats.columns == ["transaction_id", *fraud.RETURN_FEATURES]
    row = make_returns(spark).first()
    assert feats.first()["return_amount_log"] == pytest.approx(np.log1p(row["return_amount"]))


def test_thresholds_come_from_training_scores_only(spark):
    train = spark.createDataFrame([(i / 10,) for i in range(1, 11)], "score double")
    (p90,) = fraud.thresholds(train, [0.9])
    assert p90 == pytest.approx(0.91)
    scored = spark.createDataFrame([(0.05,), (0.5,), (0.95,), (1.5,)], "score double")
    flags = fraud.flag(scored, p90, 1.0).orderBy("score").collect()
    assert [r["flagged_p95"] for r in flags] == [False, False, True, True]
    assert [r["severity"] for r in flags] == ["low", "low", "medium", "high"]


def test_quality(spark):
    rows = list(zip([0, 0, 1, 1, 0, 1], [False, True, True, True, False, False]))
    row = fraud.flag_quality(spark.createDataFrame(rows, "label int, f boolean"), "f").first()
    assert (row["n_flagged"], row["n_actual"]) == (3, 3)
    assert row["precision"] == row["recall"] == row["f1"] == pytest.approx(0.6667)
    none = fraud.flag_quality(spark.createDataFrame([(0, False)], "label int, f boolean"), "f").first()
    assert (none["precision"], none["recall"], none["f1"]) == (0.0, 0.0, 0.0)


def test_pca_baseline_matches_numpy(spark):
    log = train_monitor(make_returns(spark))
    train = log.where("is_train")
    scaler = fraud.fit_scaler(train)
    got = fraud.pca_score(fraud.fit_pca(train, scaler), scaler, log).orderBy("transaction_id").toPandas()
    x = fraud.return_features(log).orderBy("transaction_id").toPandas()[list(fraud.RETURN_FEATURES)].to_numpy()
    fit = x[got["is_train"].to_numpy()]
    z = (x - fit.mean(0)) / fit.std(0)
    zt = (fit - fit.mean(0)) / fit.std(0)
    p = np.linalg.svd(zt, full_matrices=False)[2][:3].T
    np.testing.assert_allclose(got["score"], ((z - z @ p @ p.T) ** 2).mean(1), atol=1e-9)


def test_pipeline_end_to_end(spark, tmp_path):
    returns = make_returns(spark)
    summary = pipelines.run_fraud(returns, str(tmp_path / "models"), str(tmp_path / "reports"), epochs=20).first()
    assert (summary["n_train"], summary["n_monitor"]) == (350, 150)
    assert summary["threshold_p99"] > summary["threshold_p95"] > 0
    assert summary["eval_p95"]["n_flagged"] >= summary["eval_p99"]["n_flagged"]
    feed = spark.read.json(str(tmp_path / "reports" / "fraud_alerts.json"))
    assert "label" not in feed.columns and feed.count() == 150
    line = next((tmp_path / "reports" / "fraud_alerts.json").glob("part-*.json")).read_text().splitlines()[0]
    assert "T" in json.loads(line)["ts"]
    # planted anomalies score higher than the rest
    result = pipelines.fraud_detection(returns)
    means = {r["label"]: r["m"] for r in result["scored"].groupBy("label").agg(F.avg("score").alias("m")).collect()}
    assert means[1] > 1.5 * means[0]


def test_stream_equals_batch(spark, tmp_path):
    log = train_monitor(make_returns(spark))
    train, monitor = log.where("is_train"), log.where("not is_train").drop("is_train")
    scaler = fraud.fit_scaler(train)
    model = fraud.fit_autoencoder(train, scaler, epochs=20)
    p95, p99 = fraud.thresholds(fraud.autoencoder_score(model, scaler, train))

    def score(df):
        return fraud.autoencoder_score(model, scaler, df)

    source = str(tmp_path / "in")
    monitor.repartitionByRange(4, "ts").write.parquet(source)
    stream = spark.readStream.schema(monitor.schema).option("maxFilesPerTrigger", 1).parquet(source)
    out = str(tmp_path / "out")
    write_alerts(score_stream(stream, score, p95, p99), out, str(tmp_path / "cp"), only_flagged=False).awaitTermination(120)
    batch = fraud.flag(score(monitor), p95, p99).drop("label")
    streamed = spark.read.parquet(out)
    assert streamed.count() == 150
    assert batch.select(sorted(batch.columns)).exceptAll(streamed.select(sorted(batch.columns))).count() == 0

    delivered = []
    query = deliver_alerts(
        score_stream(stream, score, p95, p99), lambda df, i: delivered.append((i, df.count())), str(tmp_path / "cp2")
    )
    query.awaitTermination(120)
    assert sum(n for _, n in delivered) == batch.where("flagged_p95").count()


def test_frequency_stream_counts_and_drops_late_rows(spark, tmp_path):
    hour = dt.timedelta(hours=1)
    start = dt.datetime(2024, 1, 1)
    batches = [
        [(1, start + 2 * hour, True), (1, start + 3 * hour, True), (2, start + 3 * hour, False)],
        [(1, start + 60 * hour, True)],
        # the watermark of a batch filters the rows of the batch after the next
        [(3, start + 61 * hour, False)],
        [(1, start + 4 * hour, True), (1, start + 120 * hour, True)],
    ]
    schema = "customer_id bigint, ts timestamp, is_return boolean"
    source = tmp_path / "events"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(source / f"b={i}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source / "*"))
    query = (
        return_frequency_stream(stream)
        .writeStream.format("memory").queryName("freq").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    counts = {(r["start"], r["customer_id"]): r["returns_24h"] for r in spark.table("freq").collect()}
    assert counts[(start, 1)] == 2
    assert all(customer == 1 for _, customer in counts)  # views are not counted
    assert max(counts.values()) == 2


def test_rows_with_a_missing_feature_are_unscored_and_not_learned_from(spark):
    returns = make_returns(spark)
    holes = returns.withColumn(
        "days_since_purchase", F.when(F.col("transaction_id") % 50 != 7, F.col("days_since_purchase"))
    )
    n = holes.where("days_since_purchase is null").count()
    assert n > 0
    scaler = fraud.fit_scaler(holes)
    known = fraud.complete(holes)
    assert known.count() == holes.count() - n
    model = fraud.fit_autoencoder(holes, scaler, epochs=3)
    assert not any(w != w for w in model._flat())
    components = fraud.fit_pca(holes, scaler)
    for scored in (fraud.autoencoder_score(model, scaler, holes), fraud.pca_score(components, scaler, holes), fraud.mean_score(scaler, holes)):
        flagged = fraud.flag(scored, *fraud.thresholds(scored))
        out = flagged.where("severity = 'unscored'")
        assert out.count() == n and out.where("score is null and not flagged_p95 and not flagged_p99").count() == n
        assert flagged.where("score is null or isnan(score)").count() == n
