"""Ranked lexical search with classes of documents that score alike.

A document's score for an item depends only on its counts of the items' terms and on its length factor m. So
texts are first restricted to the vocabulary of the items: a document becomes its sorted (term, count) vector
and m. Documents of the same vector and m form a class: they are found by a hash and verified by the vector
itself, which is part of the grouping key, and the copies are combined in each task before the shuffle. Every
class is scored once, against all items, in blocks: the contributions of its terms are added up along the
items' postings. Each task keeps the best classes of each item; the winners of all tasks are expanded into
their documents by ascending ``doc_id``. A class can fill no more than the wanted places, so at most that many
of its members are kept in each task, however many copies a class has.

The items are the stated query set. They are taken in blocks of about ``ITEM_BYTES`` of text and at most about
``ITEM_ROWS`` items; a block's vocabulary and weights go to every task, so that is the bound on what is
broadcast. All documents meet every block.

All arithmetic is on 64-bit integers, the weights of terms alone come from a logarithm.

Defined results: null and empty texts have no terms and are never found; a null ``doc_id`` comes after all
others; repeated rows are ranked one by one; each row of the items is ranked by itself, also those of equal or
null ``item_id``; an item without terms, and an empty table, give no rows; other columns play no part.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .staging import slices, staged

# Fixed values of the contract: terms (on bytes: ASCII letters and digits, and all of UTF-8 beyond ASCII) and scores.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
BEST = 20
SCALE = 1_000_000_000

ITEM_BYTES = 8 << 20
ITEM_ROWS = 10_000
#: Cells (classes x items) and postings that are added up at a time.
CELLS = 1 << 21


def terms(text: bytes | None) -> list[bytes]:
    return TERM.findall((text or b"").lower())


class Items:
    """The terms of a block of items, and for each term the items that hold it."""

    def __init__(self, texts: list[bytes]) -> None:
        counts = [Counter(terms(t)) for t in texts]
        self.size = len(texts)
        self.number: dict[bytes, int] = {}
        for count in counts:
            for term in count:
                self.number.setdefault(term, len(self.number))
        found = [(self.number[t], i, n) for i, count in enumerate(counts) for t, n in count.items()]
        table = np.array(sorted(found), np.int64).reshape(-1, 3)
        self.item, self.times = table[:, 1].copy(), table[:, 2].copy()
        self.start = np.searchsorted(table[:, 0], np.arange(len(self.number) + 1))
        #: The most terms, with repeats, of any item.
        self.longest = max((sum(c.values()) for c in counts), default=0)

    def vector(self, text: bytes | None) -> tuple[int, bytes]:
        """The number of a text's terms, and its counts of the items' terms as pairs of 32-bit numbers."""
        found = terms(text)
        number = self.number
        pairs = sorted([(number[t], n) for t, n in Counter(found).items() if t in number])
        return len(found), np.array(pairs, "<u4").tobytes()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def vectors(docs: DataFrame, items, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(``doc_id``, ``n``, ``vector``) of each row; ``items`` is the broadcast block of items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = items.value
        for batch in slices(batches):
            made = [block.vector(t) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            columns = [pa.array([m[0] for m in made], pa.int64()), pa.array([m[1] for m in made], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n", "vector"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n long, vector binary")


def _pairs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The (term, count) pairs of all vectors of a batch, and how many each vector has."""
    raw = column.to_pylist()
    sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // 8
    return np.frombuffer(b"".join(raw), "<u4").reshape(-1, 2).astype(np.int64), sizes


def holding(rows: DataFrame, size: int) -> np.ndarray:
    """In how many documents each of ``size`` terms occurs; one counter for each term leaves a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            pairs, _ = _pairs(batch.column(0))
            counts += np.bincount(pairs[:, 0], minlength=size)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(counts[seen])], names=["term", "n"])

    out = np.zeros(size, np.int64)
    found = rows.select("vector").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    for term, n in found.collect():  # as many rows as the block of items has terms
        out[term] = n
    return out


class Scorer:
    """Scores of classes for all items of a block, and the best classes of each item so far."""

    def __init__(self, items: Items, weights: np.ndarray, best: int) -> None:
        self.items, self.weights, self.best = items, weights, best
        self.item = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.order: list[tuple] = []  # (doc_id is null, doc_id) of the first member
        self.kept: list[tuple] = []
        self.least = np.ones(items.size, np.int64)  # what a class must reach to be among the best
        # doubles add whole numbers exactly up to 2 ** 53
        top = int(weights.max(initial=0)) * (SCALE // 1000) * items.longest
        self.exact = top < 1 << 53

    def scores(self, pairs: np.ndarray, sizes: np.ndarray, m: np.ndarray) -> np.ndarray:
        """A matrix of scores: a row for each class, a column for each item."""
        items, row = self.items, np.repeat(np.arange(len(sizes)), sizes)
        term, count = pairs[:, 0], pairs[:, 1]
        worth = self.weights[term] * ((SCALE * count) // (1000 * count + 12 * m[row]))
        width = items.start[term + 1] - items.start[term]
        at = np.repeat(items.start[term] - (np.cumsum(width) - width), width) + np.arange(width.sum())
        cell = np.repeat(row, width) * items.size + items.item[at]
        added = np.repeat(worth, width) * items.times[at]
        if self.exact:
            out = np.bincount(cell, added, len(sizes) * items.size).astype(np.int64)
        else:
            out = np.zeros(len(sizes) * items.size, np.int64)
            np.add.at(out, cell, added)
        return out.reshape(len(sizes), items.size)

    def chunks(self, pairs: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(first class, end, first pair, end) of parts with a bounded number of cells and postings."""
        width = self.items.start[pairs[:, 0] + 1] - self.items.start[pairs[:, 0]]
        ends = np.cumsum(sizes)
        spent = np.r_[0, np.cumsum(width)][np.r_[0, ends]]
        at = 0
        while at < len(sizes):
            upto = int(np.searchsorted(spent, spent[at] + CELLS, side="right")) - 1
            upto = min(max(at + 1, upto), at + max(1, CELLS // self.items.size), len(sizes))
            yield at, upto, int(ends[at] - sizes[at]), int(ends[upto - 1])
            at = upto

    def add(self, classes: list[tuple], pairs: np.ndarray, sizes: np.ndarray, m: np.ndarray) -> None:
        """``classes``: what is kept of a class, first the ``doc_id`` of its first member."""
        for a, b, p, q in self.chunks(pairs, sizes):
            table = self.scores(pairs[p:q], sizes[a:b], m[a:b])
            least = self.least
            if b - a > self.best:
                high = np.partition(table, b - a - self.best, axis=0)[b - a - self.best]
                least = np.maximum(least, high)
            row, item = np.nonzero(table >= least)
            if not len(row):
                continue
            self.item = np.r_[self.item, item]
            self.score = np.r_[self.score, table[row, item]]
            for k in row.tolist():
                first = classes[a + k][0]
                self.order.append((first is None, first if first is not None else 0))
                self.kept.append(classes[a + k])
            self._trim()

    def _trim(self) -> None:
        rank = np.empty(len(self.order), np.int64)
        rank[sorted(range(len(self.order)), key=self.order.__getitem__)] = np.arange(len(self.order))
        by = np.lexsort((rank, -self.score, self.item))
        item = self.item[by]
        first = np.searchsorted(item, item, side="left")
        by = by[np.arange(len(by)) - first < self.best]
        self.item, self.score = self.item[by], self.score[by]
        self.order, self.kept = [self.order[k] for k in by], [self.kept[k] for k in by]
        full = np.flatnonzero(np.bincount(self.item, minlength=self.items.size) >= self.best)
        last = np.searchsorted(self.item, full, side="right") - 1
        self.least[full] = self.score[last]


def best_classes(classes: DataFrame, items, weights, best: int) -> DataFrame:
    """(``item``, ``score``, ``first``, ``hash``, ``m``, ``vector``): the best classes of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(items.value, weights.value, best)
        for batch in slices(batches, 4096):
            pairs, sizes = _pairs(batch.column("vector"))
            kept = list(zip(*[batch.column(c).to_pylist() for c in ("first", "hash", "m", "vector")], strict=True))
            scorer.add(kept, pairs, sizes, batch.column("m").to_numpy())
        for at in range(0, len(scorer.kept), 10_000):
            part = scorer.kept[at : at + 10_000]
            columns = [pa.array(scorer.item[at : at + 10_000]), pa.array(scorer.score[at : at + 10_000])]
            columns += [pa.array([p[k] for p in part], field.type) for k, field in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kinds = to_arrow_schema(classes.select("first", "hash", "m", "vector").schema)
    kind = classes.schema["first"].dataType.simpleString()
    names = ["item", "score", "first", "hash", "m", "vector"]
    found = classes.select("first", "hash", "m", "vector").mapInArrow(
        run, f"item long, score long, first {kind}, hash long, m long, vector binary"
    )
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("first"), "hash", "m")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= best).drop("place")


def _block(docs: DataFrame, rows: list, best: int) -> DataFrame:
    """(``item``, ``rank``, ``doc_id``, ``score``) of a block of items, given as rows with their text first."""
    spark = docs.sparkSession
    items = Items([(r[0] or "").encode() for r in rows])
    shared = spark.sparkContext.broadcast(items)
    found = staged(vectors(docs, shared), "vectors")
    sums = found.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("terms")).first()
    documents, total = sums["documents"], sums["terms"] or 0
    held = holding(found, len(items.number))
    weights = spark.sparkContext.broadcast(np.array([weight(documents, int(n)) for n in held], np.int64))
    m = F.expr(f"75 + (25L * n * {documents}L) div {max(1, total)}L")
    members = found.where(F.octet_length("vector") > 0).select("doc_id", m.alias("m"), "vector")
    members = members.withColumn("hash", F.xxhash64("vector", "m"))
    classes = members.groupBy("hash", "m", "vector").agg(F.min("doc_id").alias("first"))
    winners = staged(best_classes(classes, shared, weights, best), "winners")
    # at most ``best`` hashes for each item of the block
    hashes = winners.select("hash").distinct()
    own = Window.partitionBy("hash", "m", "vector").orderBy(F.asc_nulls_last("doc_id"))
    first = members.join(F.broadcast(hashes), "hash", "left_semi")
    first = first.withColumn("place", F.row_number().over(own)).where(F.col("place") <= best).drop("place")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = winners.drop("first").join(first, ["hash", "m", "vector"]).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= best).select("item", "rank", "doc_id", "score")


def search(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", best: int = BEST, item_bytes: int = ITEM_BYTES, item_rows: int = ITEM_ROWS,
) -> DataFrame:
    """(``item_id``, ``rank``, ``doc_id``, ``score``): the ``best`` documents of each item, all rows of ``docs`` ranked."""
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    asked = items.select(F.col(item_text).alias("text"), F.col(item_id).alias("item_id"))
    size = asked.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("rows")).first()
    blocks = 1 + max((size["bytes"] or 0) // item_bytes, size["rows"] // item_rows)
    # rows are numbered once, so that equal items fall into different blocks too
    numbered = staged(asked.withColumn("row", F.monotonically_increasing_id()), "items") if blocks > 1 else asked
    schema = asked.select("item_id").schema.add("item", "long")
    out = None
    for block in range(blocks):
        mine = numbered if blocks == 1 else numbered.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block)
        rows = mine.select("text", "item_id").collect()  # one block of items
        names = spark.createDataFrame([(r["item_id"], k) for k, r in enumerate(rows)], schema)
        found = _block(docs, rows, best).join(names, "item").select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    return out
