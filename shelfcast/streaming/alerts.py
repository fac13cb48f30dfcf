"""Scoring a stream of return rows with a fitted detector."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfcast.operators.fraud import flag
from shelfcast.sources.tables import exists, renamed


def score_stream(returns: DataFrame, score: Callable[[DataFrame], DataFrame], p95: float, p99: float) -> DataFrame:
    """Stateless: the same scoring function and thresholds as in batch, applied to arriving rows."""
    return flag(score(returns), p95, p99).drop("label")


def write_alerts(scored: DataFrame, path: str, checkpoint: str, only_flagged: bool = True, **trigger) -> StreamingQuery:
    """Append alerts as parquet. The file sink commits each batch once, also after a restart."""
    alerts = scored.where("flagged_p95") if only_flagged else scored
    writer = alerts.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.option("path", path).trigger(**(trigger or {"availableNow": True})).start()


def deliver_alerts(scored: DataFrame, deliver: Callable[[DataFrame, int], None], checkpoint: str, **trigger) -> StreamingQuery:
    """Hand every micro-batch of alerts, highest score first, to ``deliver(batch, batch_id)``.

    Delivery is at least once: a sink should ignore a batch id it has already seen, as ``deliver_feed`` does.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        deliver(batch.where("flagged_p95").orderBy(batch["score"].desc(), "transaction_id"), batch_id)

    writer = scored.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def append_once(batch: DataFrame, folder: str, stream: str, batch_id: int) -> bool:
    """Add a batch of alerts to a feed, unless it is there; whether it was added.

    The batch's folder, named by stream and number, is the ledger: it gets its name by one rename when all of it
    is written, so a batch is in the feed whole or not at all, and a replay finds it.
    """
    spark, path = batch.sparkSession, f"{folder.rstrip('/')}/{stream}-{batch_id}"
    if exists(spark, path):
        return False
    draft = f"{folder.rstrip('/')}/_draft-{stream}-{batch_id}-{uuid.uuid4().hex}"
    batch.write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX").json(draft)
    return renamed(spark, draft, path)


def deliver_feed(
    scored: DataFrame, folder: str, checkpoint: str, delivered: Callable[[int], None] | None = None, **trigger
) -> StreamingQuery:
    """Append the flagged rows of a stream to a feed of JSON records, each batch exactly once.

    Batches carry the stream's id, which lives in its checkpoint, so several streams may share a feed.
    ``delivered`` is told each batch number after its rows are in the feed.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        append_once(batch.where("flagged_p95").drop("label", "is_train"), folder, stream, batch_id)
        if delivered:
            delivered(batch_id)

    writer = scored.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_feed(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """All alerts of a feed; batches that are still being written are not seen."""
    return spark.read.schema(schema).json(f"{folder.rstrip('/')}/[!_]*")
