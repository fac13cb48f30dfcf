"""Histogram sort into shards of near equal bytes, in DataFrame functions only.

Rows are ordered by a composite key: hash of the text, then ``doc_id``, then a row number that is fixed
by writing the narrow table first. The key range is cut into cells and the exact bytes and rows of
each are counted across all partitions. A cell that holds more than ``TOLERANCE`` of a shard is cut again
between the least and the greatest key that it has, on the next key column where the first has only one
value, into about ``PER_LIMIT`` cells for each such share that it holds. So a group of equal texts is spread
over as many shards as its bytes need. When no cell is too heavy the shard of each cell follows from the
bytes before it; rows are exchanged once, by cell, and numbered inside their cell on top of the rows before
the cell.

The driver sees only cells that are too heavy, at most ``shards / TOLERANCE`` by bytes and ``1 / TOLERANCE`` by rows.
The shares that a round's heavy cells hold add up to that number too, so a round makes at most
``PER_LIMIT + LEAST_CUT`` cells for each, some 130,000 for eight shards, whatever the table's size. A few rounds do.
The running sums over all cells, formed in one task, and their broadcast are as large as that. No task holds
more rows than a cell.

Defined results: null texts have no bytes and size 1; a null ``doc_id`` sorts first; equal rows are told apart
by the row number; a row larger than the tolerance stays whole; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import fresh, staged

#: Cells for each limit's worth of rows or bytes in a heavy cell, and the fewest and most cells of a cut.
PER_LIMIT = 8
LEAST_CUT = 64
MOST_CUT = 4096
TOLERANCE = 0.005
LAW = "bytes"


def _cut(cells: DataFrame, heavy: list, names: list[str]) -> DataFrame:
    """``cells`` with the path of each row one step longer where its cell is heavy."""
    spark = cells.sparkSession
    rows = [(list(r["path"]), r["key"], Decimal(r["low"]), Decimal(r["span"]), r["parts"]) for r in heavy]
    table = spark.createDataFrame(
        rows, "path array<int>, h_key int, h_low decimal(20,0), h_span decimal(20,0), h_parts int"
    )
    value = F.element_at(F.array(*[F.col(n).cast("decimal(20,0)") for n in names]), F.col("h_key"))
    step = F.floor((value - F.col("h_low")) * F.col("h_parts") / F.col("h_span")).cast("int")
    grown = F.concat("path", F.array(F.least(step, F.col("h_parts") - 1)))
    joined = cells.join(F.broadcast(table), "path", "left")
    return joined.withColumn("path", F.when(F.col("h_key").isNotNull(), grown).otherwise(F.col("path"))).drop(
        "h_key", "h_low", "h_span", "h_parts"
    )


def histogram_shards(
    rows: DataFrame, keys: list[str], size: str, shards: int = 8, tolerance: float = TOLERANCE
) -> DataFrame:
    """``rows`` with ``shard`` (from 0) and ``slot`` (gapless from 0 in each shard, in key order).

    ``keys`` are columns of longs without nulls that together are unique; ``size`` is a positive long. ``rows`` is read once in
    each round, so it should be a written table.
    """
    total = rows.agg(F.sum(size).alias("s"), F.count("*").alias("n")).first()
    everything, number = int(total["s"] or 0), int(total["n"])
    most_bytes = max(1, int(everything * tolerance / shards))
    most_rows = max(1000, int(number * tolerance))
    cells = rows.withColumn("path", F.array().cast("array<int>"))
    level = 0
    while True:
        ranges = [x for n in keys for x in (F.min(n).alias(f"low_{n}"), F.max(n).alias(f"high_{n}"))]
        counted = cells.groupBy("path").agg(F.sum(size).alias("cell_bytes"), F.count("*").alias("cell_rows"), *ranges)
        open_cells = counted.where(
            (F.size("path") == level)
            & (F.col("cell_rows") > 1)
            & ((F.col("cell_bytes") > most_bytes) | (F.col("cell_rows") > most_rows))
        ).collect()
        heavy = []
        for r in open_cells:
            limits = max(r["cell_bytes"] / most_bytes, r["cell_rows"] / most_rows)
            parts = min(MOST_CUT, max(LEAST_CUT, math.ceil(PER_LIMIT * limits)))
            for k, n in enumerate(keys):
                if r[f"low_{n}"] != r[f"high_{n}"]:
                    span = int(r[f"high_{n}"]) - int(r[f"low_{n}"]) + 1
                    heavy.append({"path": r["path"], "key": k + 1, "low": r[f"low_{n}"], "span": span, "parts": parts})
                    break
        if not heavy:
            break
        cells = _cut(cells, heavy, keys)
        level += 1
    before = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.select(
        "path",
        "cell_rows",
        "cell_bytes",
        F.coalesce(F.sum("cell_bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("cell_rows").over(before), F.lit(0)).alias("rows_before"),
    )
    middle = F.col("bytes_before") + F.col("cell_bytes") / 2
    placed = placed.withColumn(
        "shard", F.least(F.floor(middle * shards / max(1, everything)), F.lit(shards - 1)).cast("int")
    )
    starts = F.min("rows_before").over(Window.partitionBy("shard"))
    placed = placed.select("path", "shard", (F.col("rows_before") - starts).alias("slot_start"))
    in_cell = Window.partitionBy("path").orderBy(*keys)
    ranked = cells.withColumn("rank", F.row_number().over(in_cell) - 1)
    return ranked.join(F.broadcast(placed), "path").select(
        *rows.columns, "shard", (F.col("slot_start") + F.col("rank")).cast("long").alias("slot")
    )


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(``doc_id``, ``size``, ``text_crc32``) and the sort keys of each row, written once."""
    value = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(value).cast("long") + 1).alias("size"),
        F.crc32(value.cast("binary")).alias("text_crc32"),
        F.xxhash64(value).alias("key_text"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63))).alias("key_id"),
        F.monotonically_increasing_id().alias("key_row"),
    )
    return staged(narrow, "shard-keys")


def shard_documents(docs: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``shard``, ``slot``: what a writer partitions by. Needs no fixed row order."""
    names = {n: fresh(n, docs.columns) for n in ("key_text", "key_id", "key_row", "key_size")}
    value = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(
        "*",
        F.xxhash64(value).alias(names["key_text"]),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63))).alias(names["key_id"]),
        F.monotonically_increasing_id().alias(names["key_row"]),
        (F.octet_length(value).cast("long") + 1).alias(names["key_size"]),
    )
    keys = [names["key_text"], names["key_id"], names["key_row"]]
    return histogram_shards(staged(keyed, "shard-rows"), keys, names["key_size"], shards).drop(*names.values())


def by_bytes(docs: DataFrame, shards: int = 8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(``doc_id``, ``size``, ``text_crc32``, ``shard``, ``slot``) of each row of ``docs``."""
    keys = ["key_text", "key_id", "key_row"]
    return histogram_shards(digests(docs, doc_id, text), keys, "size", shards).drop(*keys)
