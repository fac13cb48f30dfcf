"""Exact customer history on a stream: what ``derive_history`` gives in batch, row by row, once it is final."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

DAY_MICROS = 86_400_000_000
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_PENDING = "transaction_id bigint, at bigint, is_return boolean, is_purchase boolean"
_KNOWN = "first_at bigint, bought_at bigint"
_RECENT = "at bigint, n bigint"


class _History(StatefulProcessor):
    """State of a customer: rows that wait for the watermark, returns of the last day, first event, latest purchase.

    A row is final when the watermark has passed it, since then nothing earlier can arrive. An event-time timer
    at that instant hands it on, with all other rows that are final by then, in the order of time.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", _PENDING)
        self.recent = handle.getListState("recent", _RECENT)
        self.known = handle.getValueState("known", _KNOWN)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        first = None
        for frame in rows:
            # what the watermark has passed came too late
            frame = frame[frame["at"] >= passed * 1000]
            if not frame.empty:
                columns = (frame[c].tolist() for c in ("transaction_id", "at", "is_return", "is_purchase"))
                self.pending.appendList(list(zip(*columns, strict=True)))
                least = int(frame["at"].min())
                first = least if first is None else min(first, least)
        if first is not None:
            self.handle.registerTimer(first // 1000 + 1)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = sorted(self.pending.get(), key=lambda r: (r[1], r[0] is None, r[0] or 0))
        final = [r for r in waiting if r[1] < passed]
        rest = [tuple(r) for r in waiting if r[1] >= passed]
        known = self.known.get() if self.known.exists() else None
        first_at, bought_at = (known[0], known[1]) if known else (None, None)
        recent = [(int(r[0]), int(r[1])) for r in self.recent.get()] if self.recent.exists() else []
        out, k, opened = [], 0, 0  # the returns of the day before the row are recent[opened:]
        count = sum(n for _, n in recent)
        while k < len(final):
            at = final[k][1]
            same = k
            while same < len(final) and final[same][1] == at:
                same += 1
            first_at = at if first_at is None else min(first_at, at)
            while opened < len(recent) and recent[opened][0] < at - DAY_MICROS:
                count -= recent[opened][1]
                opened += 1
            here = final[k:same]
            since = None if bought_at is None else (at - bought_at) // DAY_MICROS
            out += [(r[0], at, count, since, (at - first_at) // DAY_MICROS) for r in here if r[2]]
            returned = sum(bool(r[2]) for r in here)
            if returned:
                recent.append((at, returned))
                count += returned
            if any(r[3] for r in here):
                bought_at = at
            k = same
        if final:
            self.known.update((first_at, bought_at))
            kept = [r for r in recent[opened:] if r[0] >= passed - DAY_MICROS]
            self.recent.put(kept) if kept else self.recent.clear()
            self.pending.put(rest) if rest else self.pending.clear()
        if rest:
            self.handle.registerTimer(rest[0][1] // 1000 + 1)
        if out:
            frame = pd.DataFrame(out, columns=["transaction_id", "at", "return_frequency_24h", "days_since_purchase", "customer_tenure_days"])
            frame["days_since_purchase"] = frame["days_since_purchase"].astype("Int64")
            frame.insert(0, "customer_id", key[0])
            yield frame

    def close(self) -> None:
        pass


def history_stream(activity: DataFrame, late: str = "1 hour") -> DataFrame:
    """``return_frequency_24h``, ``days_since_purchase`` and ``customer_tenure_days`` of each return of a stream.

    The same values as ``derive_history`` on the same events: the count is that of the customer's returns in the
    24 hours before the row's own instant, to the microsecond. Rows are handed on once, in append mode, when the
    watermark (``late`` behind the newest event) has passed them; rows that arrive behind it are dropped, as are
    rows without a time. State of a customer: rows that wait, instants of returns of the last day, two instants
    for ever. It is kept in Spark's RocksDB store, which has to be the session's (``PROVIDER``).
    """
    spark = activity.sparkSession
    if spark.conf.get(PROVIDER, "") != ROCKS:
        raise ValueError(f"set {PROVIDER} to {ROCKS}")
    kind = activity.schema["customer_id"].dataType
    events = activity.withWatermark("ts", late).select(
        "customer_id",
        "ts",
        F.col("transaction_id").cast("bigint").alias("transaction_id"),
        F.unix_micros("ts").alias("at"),
        F.coalesce("is_return", F.lit(False)).alias("is_return"),
        F.coalesce("is_purchase", F.lit(False)).alias("is_purchase"),
    )
    schema = T.StructType(
        [T.StructField("customer_id", kind)]
        + [
            T.StructField(c, T.LongType())
            for c in ("transaction_id", "at", "return_frequency_24h", "days_since_purchase", "customer_tenure_days")
        ]
    )
    out = events.where("ts is not null").groupBy("customer_id").transformWithStateInPandas(
        statefulProcessor=_History(), outputStructType=schema, outputMode="Append", timeMode="EventTime"
    )
    return out.select(
        "transaction_id",
        "customer_id",
        F.timestamp_micros("at").alias("ts"),
        "return_frequency_24h",
        "days_since_purchase",
        "customer_tenure_days",
    )
