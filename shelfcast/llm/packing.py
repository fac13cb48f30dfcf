"""Token ids packed into fixed-width rows by best-fit decreasing.

Texts are tokenized once, each followed by an end id, and cut into pieces no longer than a row; together the
pieces of a text are its ids, nothing is dropped. Pieces are dealt by a hash of their row's number, so also
equal rows spread, to groups of about ``GROUP_BYTES`` (text, and ``ROW_BYTES`` for each row, so that a table of
empty texts is divided too), and each group is packed by itself: longest
pieces first, each into the fullest row that still has room. A segment tree over the free capacities
(0 to the row's width) finds that row in logarithmic time: its leaves count the open rows of each free
capacity, and the search is for the least capacity that is large enough.

A packed row holds the ids (little-endian, 16 or 32 bits, padded to the width), the cumulative segment lengths
beginning with 0, and position ids that start again at 0 with each segment.

Defined results: null is treated as the empty text, whose only id is the end id; equal rows are packed as
separate pieces; an overlong text gives pieces of full width and a rest; ids of documents may have any type,
nulls included; an empty table gives no rows; other columns, however they are called, play no part.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .staging import slices

WIDTH = 2048
END_ID = 50256
GROUP_BYTES = 4 << 20
ROW_BYTES = 256
OUTPUT_BYTES = 8 << 20


def load_encoding(path: str, pattern: str) -> tiktoken.Encoding:
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("byte-level", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class Capacities:
    """Open rows by free capacity, in a segment tree of counts."""

    def __init__(self, width: int) -> None:
        self.leaves = 1 << width.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(width + 1)]

    def add(self, free: int, row: int) -> None:
        self.rows[free].append(row)
        node = free + self.leaves
        while node:
            self.counts[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The open row with the least free capacity of at least ``need``, and that capacity."""
        counts, node = self.counts, need + self.leaves
        if not counts[node]:
            # up to the first ancestor with rows in a right-hand branch, then down to its least leaf
            while node > 1 and (node & 1 or not counts[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node <<= 1
                if not counts[node]:
                    node += 1
        free = node - self.leaves
        row = self.rows[free].pop()
        while node:
            counts[node] -= 1
            node >>= 1
        return row, free


def best_fit(lengths: list[int], width: int) -> list[int]:
    """The row of each piece; ``lengths`` must fall and be 1 to ``width``."""
    open_rows, placed, made = Capacities(width), [], 0
    for length in lengths:
        found = open_rows.take(length)
        if found is None:
            row, free = made, width
            made += 1
        else:
            row, free = found
        placed.append(row)
        if free > length:
            open_rows.add(free - length, row)
    return placed


def tokenized(
    docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH,
    end_id: int = END_ID,
) -> DataFrame:
    """Pieces of at most ``width`` ids (``row``, ``doc_id``, ``segment``, ``n_segments``, ``n_tokens``, ``ids``)."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    field = rows.schema["doc_id"].dataType
    arrow = to_arrow_type(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = None
        for batch in slices(batches):
            encoding = encoding or load_encoding(path, pattern)
            kind = np.dtype("<u2") if max(encoding.n_vocab, end_id + 1) <= 1 << 16 else np.dtype("<u4")
            rows: list[tuple] = []
            size = 0
            for number, key, value in zip(*batch.columns, strict=True):
                ids = np.append(np.array(encoding.encode_ordinary(value.as_py() or ""), kind), kind.type(end_id))
                count = -(-len(ids) // width)
                for k in range(count):
                    part = ids[k * width : (k + 1) * width]
                    rows.append((number.as_py(), key.as_py(), k, count, len(part), part.tobytes()))
                size += ids.nbytes
                if size > OUTPUT_BYTES:
                    yield _batch(rows, arrow)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, arrow)

    schema = f"row long, doc_id {field.simpleString()}, segment int, n_segments int, n_tokens int, ids binary"
    return rows.mapInArrow(run, schema)


NAMES = ["row", "doc_id", "segment", "n_segments", "n_tokens", "ids"]


def _batch(rows: list[tuple], doc_id: pa.DataType) -> pa.RecordBatch:
    kinds = [pa.int64(), doc_id, pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=NAMES)


def packed(pieces: DataFrame, groups: int, width: int = WIDTH, pad_id: int = END_ID, id_bytes: int = 2) -> DataFrame:
    """Packed rows of each group of pieces, as ``tokenized`` makes them. ``id_bytes``: bytes of one id in ``ids``.

    A packed row has ``pack_group``, ``pack_row``, ``n_tokens``, ``ids``, ``cu_seqlens``, ``positions`` and its ``segments``.
    """
    kind = np.dtype(f"<u{id_bytes}")
    group = F.pmod(F.xxhash64("row", "segment"), F.lit(groups)).cast("int")
    key_type = pieces.schema["doc_id"].dataType
    segment_type = pa.struct(
        [
            ("doc_id", to_arrow_type(key_type)),
            ("segment", pa.int32()),
            ("n_segments", pa.int32()),
            ("n_tokens", pa.int32()),
            ("start", pa.int32()),
        ]
    )
    made_types = pa.schema(
        [
            ("pack_group", pa.int32()),
            ("pack_row", pa.int32()),
            ("n_tokens", pa.int32()),
            ("ids", pa.binary()),
            ("cu_seqlens", pa.list_(pa.int32())),
            ("positions", pa.binary()),
            ("segments", pa.list_(segment_type)),
        ]
    )

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        pieces = list(zip(*[table.column(c).to_pylist() for c in NAMES], strict=True))
        pieces.sort(key=lambda p: (-p[4], p[0], p[2]))
        place = best_fit([p[4] for p in pieces], width)
        members: list[list[tuple]] = [[] for _ in range(max(place, default=-1) + 1)]
        for row, piece in zip(place, pieces, strict=True):
            members[row].append(piece)
        made = []
        for row, inside in enumerate(members):
            ends = np.cumsum([p[4] for p in inside]).tolist()
            ids = np.full(width, pad_id, kind)
            ids[: ends[-1]] = np.frombuffer(b"".join(p[5] for p in inside), kind)
            positions = np.zeros(width, "<u4")
            segments = []
            for (_, doc_id, segment, count, length, _), end in zip(inside, ends, strict=True):
                positions[end - length : end] = np.arange(length)
                segments.append(
                    {"doc_id": doc_id, "segment": segment, "n_segments": count, "n_tokens": length, "start": end - length}
                )
            made.append((key[0].as_py(), row, ends[-1], ids.tobytes(), [0, *ends], positions.tobytes(), segments))
        columns = list(zip(*made, strict=True)) or [[]] * len(made_types)
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, made_types, strict=True)], schema=made_types)

    schema = (
        "pack_group int, pack_row int, n_tokens int, ids binary, cu_seqlens array<int>, positions binary, "
        f"segments array<struct<doc_id: {key_type.simpleString()}, segment: int, n_segments: int, n_tokens: int, start: int>>"
    )
    grouped = pieces.select(*NAMES, group.alias("pack_group")).groupBy("pack_group")
    return grouped.applyInArrow(pack, schema)


def pack_documents(
    docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH,
    end_id: int = END_ID, group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """Tokenize and pack whole documents. The number of groups follows from the bytes of all texts and the rows."""
    total = docs.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(ROW_BYTES).cast("long"))).first()[0] or 0
    pieces = tokenized(docs, path, pattern, doc_id, text, width, end_id)
    return packed(pieces, 1 + int(total) // group_bytes, width, end_id)


def little_endian_hex(number: Column) -> Column:
    """The eight hex digits of a 32-bit number's bytes, lowest first."""
    digits = F.lpad(F.hex(number), 8, "0")
    return F.concat(*[F.substring(digits, at, 2) for at in (7, 5, 3, 1)])


def write_packed(rows: DataFrame, folder: str) -> None:
    """Id matrices, cumulative lengths and positions as Parquet, one directory for each pack group."""
    rows.write.partitionBy("pack_group").parquet(folder)
