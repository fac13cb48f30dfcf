"""Exact order statistics without a global sort and without gathering a column in one task.

Spark's ``percentile`` and ``median`` keep every distinct value in one buffer, and a rank over an
unpartitioned window runs in one task. Here a wanted rank is first bracketed (by exact counts of cells or
by the column's range), the bracket is cut into bins that are counted with map-side aggregation, and only
the bin that holds the rank is cut again. Rounds read the small table of bracketed values where there is one, and bring at most
``BINS`` counters per wanted rank to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.session import stage

BINS = 4096
# Generated code stays small enough to be compiled; each part scans its own columns only.
_COLUMNS_PER_SCAN = 8
# Logarithmic cells that are looked up together; as many as there are between a power of two and the next
ACCURACY = 4_096


class _Search:
    """Narrowing state of one wanted rank in one column."""

    def __init__(self, column: str, rank: int, low, high, below: int = 0):
        self.column, self.rank = column, rank
        self.low, self.high = low, high
        self.below = below  # rows smaller than ``low``
        self.value = low if low == high else None
        self.n = 0  # rows between ``low`` and ``high``, once counted
        self.top = 0


def _bin(column: Column, integral: bool, low, high) -> Column:
    if integral:
        width = max(1, math.ceil((high - low + 1) / BINS))
        offset = column.cast("bigint") - F.lit(low)
        return ((offset - F.pmod(offset, F.lit(width))) / F.lit(width)).cast("int")
    width = (high - low) / BINS
    if width == 0 or math.isinf(width):
        # the range is at the edge of double precision: split it at its middle
        middle = low / 2 + high / 2
        return (column > F.lit(middle)).cast("int")
    return F.least(F.floor((column - F.lit(low)) / F.lit(width)), F.lit(BINS)).cast("int")


def _locate(df: DataFrame, searches: list[_Search], weight: str | None = None) -> dict[tuple[str, int], tuple]:
    """(value, number of smaller rows) of every search, narrowing all of them together.

    With ``weight`` a row counts as often as that column says.
    """
    times = F.col(weight) if weight else F.lit(1)
    integral = {s.column: isinstance(df.schema[s.column].dataType, T.IntegralType) for s in searches}
    while True:
        open_ = [s for s in searches if s.value is None]
        if not open_:
            break
        # ranks that still share a range share its counters
        ranges = sorted({(s.column, s.low, s.high) for s in open_})
        common = "bigint" if all(integral[c] for c, _, _ in ranges) else "double"
        parts = []
        for at in range(0, len(ranges), _COLUMNS_PER_SCAN):
            cells, inside = [], F.lit(False)
            for i in range(at, min(at + _COLUMNS_PER_SCAN, len(ranges))):
                c, low, high = ranges[i]
                value = F.col(c)
                hit = value.between(F.lit(low), F.lit(high))
                inside = inside | hit
                cell = F.struct(
                    F.lit(i).alias("range"),
                    _bin(value, integral[c], low, high).alias("bin"),
                    value.cast(common).alias("value"),
                    times.cast("bigint").alias("times"),
                )
                cells.append(F.when(hit, cell))
            parts.append(df.where(inside).select(F.explode(F.array(*cells)).alias("cell")).where("cell is not null"))
        counted = (
            reduce(DataFrame.union, parts)
            .select("cell.*")
            .groupBy("range", "bin")
            .agg(F.sum("times").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
            .collect()
        )
        per_range: dict[int, list] = {}
        for row in counted:
            per_range.setdefault(row["range"], []).append(row)
        index = {r: i for i, r in enumerate(ranges)}
        for s in open_:
            seen = s.below
            for row in sorted(per_range[index[(s.column, s.low, s.high)]], key=lambda r: r["bin"]):
                if seen + row["n"] > s.rank:
                    s.below, s.low, s.high = seen, row["low"], row["high"]
                    if s.low == s.high or seen == s.rank:
                        s.value = s.low
                    elif row["n"] == 2 and weight is None:
                        s.value, s.below = s.high, seen + 1
                    break
                seen += row["n"]
    return {(s.column, s.rank): (s.value, s.below) for s in searches}


class Spread(NamedTuple):
    """What two scans tell of a column: values, mean and population variance, exact quantiles; NULL and NaN left out."""

    n: int
    mean: float | None
    variance: float | None
    quantiles: list[float | None]


# Bits of a double below its cell: exponent and 12 bits of the mantissa remain, so a cell is 0.02 % wide.
_CELL_BITS = 40
# Values that a task sorts at once, over all columns
_SORTED = 1 << 22
# Such buffers whose cells a task keeps before it merges them, rows of a batch that it returns
_BUFFERS = 8
_ROWS_OUT = 65_536
_CELLS = "place int, cell bigint, n bigint, low double, high double, mean double, squares double"


def _cells_of(values: np.ndarray) -> np.ndarray:
    """Numbers of the logarithmic cells of doubles, in the values' order; from the bits, so no rounding can reorder them."""
    size = (np.abs(values).view(np.int64) >> _CELL_BITS) + 1
    return np.where(values > 0, size, np.where(values < 0, -size, 0))


def _summed_cells(values: np.ndarray, place: int) -> tuple[np.ndarray, ...]:
    """Columns of ``_CELLS`` for the values of one column; NaN is left out."""
    values = np.sort(values)  # NaN last
    values = values[: len(values) - np.count_nonzero(np.isnan(values))]
    cells = _cells_of(values)
    starts = np.flatnonzero(np.append(True, cells[1:] != cells[:-1])[: len(cells)])
    if not len(starts):
        starts = np.zeros(0, dtype=np.int64)
        return starts.astype(np.int32), starts, starts, *[np.zeros(0)] * 4
    ends = np.append(starts[1:], len(values))
    n, low, high = ends - starts, values[starts], values[ends - 1]
    with np.errstate(invalid="ignore", over="ignore"):  # infinite values have ranks, but no moments
        off = values - np.repeat(low, n)
        shift = np.add.reduceat(off, starts) / n
        squares = np.add.reduceat((off - np.repeat(shift, n)) ** 2, starts)
    return np.full(len(n), place, dtype=np.int32), cells[starts], n, low, high, low + shift, squares


def _merged_cells(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Columns of ``_CELLS`` with each cell once."""
    place, cell, n, low, high, mean, squares = (np.concatenate(c) for c in zip(*parts, strict=True))
    key = (place.astype(np.int64) << 25) + cell  # cells have 24 bits and a sign
    order = np.argsort(key, kind="stable")
    place, cell, n, low, high, mean, squares = (c[order] for c in (place, cell, n, low, high, mean, squares))
    starts = np.flatnonzero(np.diff(key[order], prepend=-(1 << 62)))
    if not len(starts):
        return place, cell, n, low, high, mean, squares
    sizes = np.diff(np.append(starts, len(key)))
    rows, lowest = np.add.reduceat(n, starts), np.minimum.reduceat(low, starts)
    with np.errstate(invalid="ignore", over="ignore"):  # infinite values have ranks, but no moments
        off = mean - np.repeat(lowest, sizes)
        shift = np.add.reduceat(n * off, starts) / rows
        squares = np.add.reduceat(squares + n * (off - np.repeat(shift, sizes)) ** 2, starts)
    return place[starts], cell[starts], rows, lowest, np.maximum.reduceat(high, starts), lowest + shift, squares


def _count_cells(batches):
    """The cells of a task's rows; ``batches`` have one column of doubles a place."""
    states, held, have = [], [], 0

    def count() -> None:
        table = pa.Table.from_batches(held)
        found = [_summed_cells(c.to_numpy().astype(float), i) for i, c in enumerate(table.columns)]
        states.append(tuple(np.concatenate(parts) for parts in zip(*found, strict=True)))
        if len(states) == _BUFFERS:
            states[:] = [_merged_cells(states)]
        held.clear()

    for b in batches:
        held.append(b)
        have += b.num_rows
        if have * b.num_columns >= _SORTED:
            count()
            have = 0
    if have:
        count()
    if states:
        names = [f.split()[0] for f in _CELLS.split(", ")]
        yield from pa.table(list(_merged_cells(states)), names=names).to_batches(max_chunksize=_ROWS_OUT)


def _table(per_place: Sequence[Sequence[int]]) -> Column:
    """Lists of numbers by place, as one literal."""
    return F.array(*[F.array(*map(F.lit, sorted(numbers))).cast("array<bigint>") for numbers in per_place])


def _at(per_place: Column, place: str) -> Column:
    return F.element_at(per_place, F.col(place) + 1)


def _long(values: DataFrame) -> DataFrame:
    """(``place``, ``value``) of all columns, so that one small piece of generated code serves any number of them."""
    return values.select(F.posexplode(F.array(*values.columns)).alias("place", "value")).where("value is not null")


def _inside(cells: DataFrame, ranges: list[tuple]) -> DataFrame:
    """(``range``, ``value``) of the values in (place, low, high) ``ranges``, numbered as listed."""
    owners: list[list[int]] = [[] for _ in range(1 + max(place for place, _, _ in ranges))]
    for r, (place, _, _) in enumerate(ranges):
        owners[place].append(r)
    near = cells.where(F.col("place") < len(owners)).select(
        F.explode(_at(_table(owners), "place")).alias("range"), "value"
    )
    near = near.select(F.col("range").cast("int"), "value")
    lows, highs = (F.array(*[F.lit(r[side]) for r in ranges]) for side in (1, 2))
    return near.where(F.col("value").between(_at(lows, "range"), _at(highs, "range")))


def _choose(search: _Search, rows: list) -> None:
    """Narrow to the one of ``rows`` (n, low, high; in order) that holds the wanted rank."""
    for row in rows:
        if search.below + row["n"] > search.rank:
            break
        search.below += row["n"]
    search.low, search.high, search.n = row["low"], row["high"], row["n"]
    if search.low == search.high or search.below == search.rank:
        search.value = search.low
    elif search.below + search.n - 1 == search.rank:
        search.value = search.high


def _narrow(cells: DataFrame, searches: list[_Search]) -> None:
    """One round over (``place``, ``value``): equal bins of each open range, counted before the shuffle."""
    ranges = sorted({(s.column, s.low, s.high) for s in searches})
    lows = F.array(*[F.lit(low) for _, low, _ in ranges])
    # a range of a cell's size never overflows; the least width is the step of the smallest doubles
    widths = F.array(*[F.lit(max((high - low) / BINS, math.ulp(0.0))) for _, low, high in ranges])
    bin_ = F.floor((F.col("value") - _at(lows, "range")) / _at(widths, "range"))
    counted = (
        _inside(cells, ranges)
        .groupBy("range", F.least(bin_, F.lit(BINS)).alias("bin"))
        .agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        .collect()
    )
    per_range: dict[int, list] = {}
    for row in sorted(counted, key=lambda r: r["bin"]):
        per_range.setdefault(row["range"], []).append(row)
    number = {r: i for i, r in enumerate(ranges)}
    for s in searches:
        _choose(s, per_range[number[(s.column, s.low, s.high)]])


def spreads(df: DataFrame, wanted: dict[str, Sequence[float]]) -> dict[str, Spread]:
    """Moments and exact quantiles (linear interpolation) of many numeric columns in two scans of ``df``.

    The first scan counts logarithmic cells, with their moments, by a sort of each column of a buffer of rows in
    the task; cells need no range beforehand, only their sums leave the task, and they give the exact rank of every cell. The second scan hands on the values of the
    cells that hold a wanted rank; all further rounds read only that small table. A cell that holds over 1 %
    of a column (values close together, far from zero) is first cut by a scan of its own for all such columns.
    """
    columns = list(wanted)
    number = [F.col(c).cast("double") for c in columns]
    values = df.select(*[F.when(~F.isnan(v), v).alias(f"v{i}") for i, v in enumerate(number)])
    # moments of the parts of a cell stay apart: together with the overall means they give exact squares
    parts = stage(values.mapInArrow(_count_cells, _CELLS), "cells")
    cells = (
        parts.groupBy("place", "cell")
        .agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
        .withColumn("top", F.floor(F.col("cell") / ACCURACY))
    )
    summed = parts.groupBy("place", F.floor(F.col("cell") / ACCURACY).alias("top")).agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum(F.col("n") * F.col("mean")).alias("total")
    )
    tops: dict[int, list] = {i: [] for i in range(len(columns))}
    for row in sorted(summed.collect(), key=lambda r: r["top"]):
        tops[row["place"]].append(row)
    ns = [sum(r["n"] for r in tops[i]) for i in tops]
    means = [sum(r["total"] for r in tops[i]) / n if n else 0.0 for i, n in enumerate(ns)]
    off = F.col("mean") - _at(F.array(*map(F.lit, means)), "place")
    squares = parts.groupBy("place").agg(F.sum(F.col("squares") + F.col("n") * off * off).alias("squares"))
    variances = {r["place"]: r["squares"] / ns[r["place"]] for r in squares.collect()}

    positions = {(i, p): (ns[i] - 1) * p for i, c in enumerate(columns) if ns[i] for p in wanted[c]}
    ranks = sorted({(i, r) for (i, _), at in positions.items() for r in (math.floor(at), math.ceil(at))})
    searches = [_Search(i, rank, None, math.nan) for i, rank in ranks]
    _search_cells(values, cells, tops, ns, searches)
    found = {(i, rank): s.value for (i, rank), s in zip(ranks, searches, strict=True)}
    out = {}
    for i, c in enumerate(columns):
        quantiles: list[float | None] = []
        for p in wanted[c]:
            if not ns[i]:
                quantiles.append(None)
                continue
            at = positions[(i, p)]
            a, b, share = found[(i, math.floor(at))], found[(i, math.ceil(at))], at - math.floor(at)
            quantiles.append(a if a == b else (1 - share) * a + share * b)
        out[c] = Spread(ns[i], means[i], variances[i], quantiles) if ns[i] else Spread(0, None, None, quantiles)
    return out


def _search_cells(values: DataFrame, cells: DataFrame, tops: dict[int, list], ns: list[int], searches: list[_Search]) -> None:
    """Give every search (``column`` is the column's number) its value; see ``spreads``."""

    def open_() -> list[_Search]:
        return [s for s in searches if s.value is None]

    hits: list[set[int]] = [set() for _ in ns]
    for s in searches:
        before = s.below
        _choose(s, tops[s.column])
        if s.value is None:
            s.top = next(r["top"] for r in tops[s.column] if (before := before + r["n"]) > s.rank)
            hits[s.column].add(s.top)
    if open_():
        fine = cells.where(F.array_contains(_at(_table(hits), "place"), F.col("top")))
        rows: dict[tuple, list] = {}
        for row in sorted(fine.select("place", "top", "cell", "n", "low", "high").collect(), key=lambda r: r["cell"]):
            rows.setdefault((row["place"], row["top"]), []).append(row)
        for s in open_():
            _choose(s, rows[(s.column, s.top)])
    while wide := [s for s in open_() if s.n > max(ns[s.column] / 100, BINS)]:
        kept = sorted({s.column for s in wide})
        for s in wide:
            s.column = kept.index(s.column)
        _narrow(_long(values.select(*[f"v{i}" for i in kept])), wide)
        for s in wide:
            s.column = kept[s.column]
    if open_():
        kept = sorted({s.column for s in open_()})
        ranges = sorted({(kept.index(s.column), s.low, s.high) for s in open_()})
        for s in open_():
            s.column = ranges.index((kept.index(s.column), s.low, s.high))
        near = _inside(_long(values.select(*[f"v{i}" for i in kept])), ranges)
        near = stage(near.select(F.col("range").alias("place"), "value"), "brackets")
        while open_():
            _narrow(near, open_())


def exact_quantiles(df: DataFrame, wanted: dict[str, Sequence[float]]) -> dict[str, list[float | None]]:
    """Exact quantiles with linear interpolation, NULL and NaN left out; None for a column without values."""
    return {c: s.quantiles for c, s in spreads(df, wanted).items()}


def weighted_quantile(counted: DataFrame, value: str, weight: str, p: float) -> float | None:
    """Exact quantile of ``value`` where each row stands for ``weight`` (a whole number) equal rows.

    Ranks are searched over sums of weights; no task gathers the values. ``counted`` is read a few times.
    """
    rows = counted.where(F.col(value).isNotNull() & (F.col(weight) > 0)).select(
        F.col(value).cast("double").alias("value"), F.col(weight).cast("bigint").alias("weight")
    )
    span = rows.agg(F.min("value").alias("low"), F.max("value").alias("high"), F.sum("weight").alias("n")).first()
    if not span["n"]:
        return None
    position = (span["n"] - 1) * p
    lo, hi = math.floor(position), math.ceil(position)
    found = _locate(rows, [_Search("value", r, span["low"], span["high"]) for r in sorted({lo, hi})], "weight")
    a, b = found[("value", lo)][0], found[("value", hi)][0]
    share = position - lo
    return a if lo == hi else (1 - share) * a + share * b


class RankIndex:
    """Rows by rank in the order of nullable integral keys, NULL after all values.

    One pass counts the rows of each cell of the leading key, with partial counts before the shuffle. ``cell``
    maps that key to cells whose number its domain bounds (days, hours of a calendar); in the same order. The
    counts answer in which cell a rank lies, for as many ranks as wanted, and how many rows there are. Only
    the keys of the rows in those cells are read again; they are staged and narrowed there.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], cell: Callable[[Column], Column] = lambda key: key):
        self.df, self.keys, self.cell = df, list(keys), cell(F.col(keys[0]))
        counted = df.groupBy(self.cell.alias("cell")).agg(F.count("*").alias("n")).collect()
        self.cells = sorted(((r["cell"], r["n"]) for r in counted), key=lambda c: (c[0] is None, c[0] or 0))
        self.n = sum(n for _, n in self.cells)

    def cuts(self, ranks: Sequence[int]) -> list[tuple]:
        """The keys of the rows at 0-based ranks, each key as the pair (1 if NULL, value or 0)."""
        if ranks and not 0 <= min(ranks) <= max(ranks) < self.n:
            raise ValueError(f"ranks {sorted(set(ranks))} of {self.n} rows")
        places, offsets = [], []
        for rank in ranks:
            for place, n in self.cells:
                if rank < n:
                    break
                rank -= n
            places.append(place)
            offsets.append(rank)
        named = [p for p in set(places) if p is not None]
        hit = F.coalesce(self.cell.isin(named), F.lit(False)) if named else F.lit(False)
        if None in places:
            hit = hit | self.cell.isNull()
        near = stage(self.df.where(hit).select(self.cell.alias("_cell"), *self.keys), "cuts")
        ties = [F.col("_cell").isNull() if p is None else F.col("_cell") == F.lit(p) for p in places]
        found: list[tuple] = [()] * len(places)
        for key in self.keys:
            own = near.select(*[F.when(t, F.col(key)).alias(f"k{i}") for i, t in enumerate(ties)])
            spans = own.agg(
                *[
                    F.struct(F.count(c).alias("n"), F.min(c).alias("low"), F.max(c).alias("high")).alias(c)
                    for c in own.columns
                ]
            ).first()
            searches = [
                _Search(c, offset, spans[c]["low"], spans[c]["high"])
                for c, offset in zip(own.columns, offsets, strict=True)
                if offset < spans[c]["n"]
            ]
            located = _locate(own, searches)
            for i, c in enumerate(own.columns):
                if (c, offsets[i]) in located:
                    value, below = located[(c, offsets[i])]
                    found[i] += (0, value)
                    ties[i] = ties[i] & (F.col(key) == F.lit(value))
                    offsets[i] -= below
                else:
                    found[i] += (1, 0)
                    ties[i] = ties[i] & F.col(key).isNull()
                    offsets[i] -= spans[c]["n"]
        return found


def rows_at_ranks(df: DataFrame, keys: Sequence[str], ranks: Sequence[int]) -> list[tuple]:
    """Key tuples found at 0-based ranks when ``df`` is ordered by integral ``keys``.

    The leading key is searched over all rows, for all ranks together; a following key only among the
    rows that tie on the keys before it. Keys without a value have no rank; a rank beyond the rows that
    have one is an error.
    """
    key, *rest = keys
    span = df.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count(key).alias("n")).first()
    if ranks and not 0 <= min(ranks) <= max(ranks) < span["n"]:
        raise ValueError(f"ranks {sorted(set(ranks))} of {key}, which has {span['n']} values")
    leading = _locate(df, [_Search(key, r, span["low"], span["high"]) for r in sorted(set(ranks))])
    found = []
    for rank in ranks:
        value, below = leading[(key, rank)]
        if not rest:
            found.append((value,))
            continue
        ties = df.where(F.col(key) == F.lit(value))
        (tail,) = rows_at_ranks(ties, rest, [rank - below])
        found.append((value, *tail))
    return found


def precedes(keys: Sequence[str], cut: Sequence) -> Column:
    """Predicate "row sorts before ``cut``" for lexicographic ``keys``; literals, so it reaches the scan."""
    before = F.lit(False)
    for key, value in reversed(list(zip(keys, cut))):
        before = (F.col(key) < F.lit(value)) | ((F.col(key) == F.lit(value)) & before)
    return before
