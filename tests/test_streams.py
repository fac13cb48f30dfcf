"""Streams: exact customer history with late rows and a restart, and alerts that are delivered once."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shelfcast.operators.returns import derive_history
from shelfcast.streaming import alerts
from shelfcast.streaming.history import PROVIDER, ROCKS, history_stream

SCHEMA = "transaction_id bigint, customer_id bigint, ts timestamp, is_return boolean, is_purchase boolean"


@pytest.fixture
def rocks(spark):
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    yield
    spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


def events(n, seed):
    rng, start = random.Random(seed), dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        minutes = rng.randrange(60 * 24 * 5)
        if rng.random() < 0.2 and rows:
            at = rows[-1][2] + dt.timedelta(hours=rng.choice([0, 24]), microseconds=rng.choice([-1, 0, 1]))
        else:
            at = start + dt.timedelta(minutes=minutes)
        # a third of the events are one customer's
        customer = 1 if rng.random() < 0.34 else rng.randrange(2, 12)
        rows.append((i, customer, at, rng.random() < 0.5, rng.random() < 0.3))
    return rows


def test_history_stream_is_the_batch_result(spark, tmp_path, rocks):
    rows = sorted(events(400, 3), key=lambda r: r[2])
    rng = random.Random(5)
    # files in order of time, but rows up to 50 minutes early or late in it
    order = sorted(rows, key=lambda r: r[2] + dt.timedelta(minutes=rng.uniform(0, 50)))
    end = max(r[2] for r in rows) + dt.timedelta(days=3)
    late = (900, 1, min(r[2] for r in rows), True, True)
    batches = [order[:120], order[120:260], order[260:] + [late], [(901, 99, end, False, False)]]
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")

    def put(number):
        spark.createDataFrame(batches[number], SCHEMA).coalesce(1).write.parquet(str(source / f"b={number}"))

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(source / "*"))
        writer = history_stream(stream).writeStream.format("parquet").option("path", out).outputMode("append")
        query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination(300)
        assert query.exception() is None

    put(0), put(1)
    run()
    put(2), put(3)
    run()  # a restart from the checkpoint
    batch = derive_history(spark.createDataFrame(rows, SCHEMA)).where("is_return")
    names = ["transaction_id", "customer_id", "ts", "return_frequency_24h", "days_since_purchase", "customer_tenure_days"]
    streamed = spark.read.parquet(out).select(names)
    expected = batch.select(names)
    assert streamed.count() == expected.count() == sum(r[3] for r in rows)
    assert expected.exceptAll(streamed).count() == 0
    assert expected.agg(F.max("return_frequency_24h")).first()[0] > 10


def test_history_stream_needs_the_store(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "t"))
    stream = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "t"))
    with pytest.raises(ValueError, match="RocksDB"):
        history_stream(stream)


def scored(spark, source):
    rows = [(i, float(i), i % 2 == 0, "low") for i in range(40)]
    schema = "transaction_id bigint, score double, flagged_p95 boolean, severity string"
    spark.createDataFrame(rows, schema).repartitionByRange(4, "transaction_id").write.parquet(source)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)


def test_a_replayed_batch_gives_no_alert_twice(spark, tmp_path):
    stream = scored(spark, str(tmp_path / "in"))
    feed, checkpoint = str(tmp_path / "feed"), str(tmp_path / "cp")
    ends = []

    def end_after_delivery(batch_id):
        # the batch is in the feed, but not yet in the stream's own log
        if batch_id == 1 and not ends:
            ends.append(batch_id)
            raise RuntimeError("ended")

    query = alerts.deliver_feed(stream, feed, checkpoint, delivered=end_after_delivery)
    with pytest.raises(Exception, match="ended"):
        query.awaitTermination(120)
    assert ends == [1]
    again = []
    alerts.deliver_feed(stream, feed, checkpoint, delivered=again.append).awaitTermination(120)
    assert again == [1, 2, 3]
    found = [r["transaction_id"] for r in alerts.read_feed(spark, feed, stream.schema).collect()]
    assert sorted(found) == list(range(0, 40, 2))
    # another stream has batches of the same numbers: they are its own
    alerts.deliver_feed(stream, feed, str(tmp_path / "cp2")).awaitTermination(120)
    assert alerts.read_feed(spark, feed, stream.schema).count() == 40


def test_a_batch_that_was_not_finished_is_written_again(spark, tmp_path):
    rows = spark.createDataFrame([(1, 2.0, True)], "transaction_id bigint, score double, flagged_p95 boolean")
    feed = str(tmp_path / "feed")
    rows.write.json(f"{feed}/_draft-s-0-x")  # left by a run that was ended while it wrote
    for _ in range(2):
        alerts.append_once(rows, feed, "s", 0)
    assert alerts.read_feed(spark, feed, rows.schema).collect() == rows.collect()
