"""Exact money arithmetic.

Amounts travel as doubles but are summed as whole 1/10000 units, so a sum does not depend on the
order in which partitions are merged: reruns and different cluster sizes give the same bits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 10_000


def units(amount: Column) -> Column:
    """Amount in whole 1/10000 units (bigint); nearest unit, without the decimal detour of ``round``."""
    return F.floor(amount * SCALE + 0.5)


def total(amount: Column) -> Column:
    """Chain-wide sum; decimal accumulator, as bigint would overflow at very large scale."""
    return F.sum(units(amount).cast("decimal(19,0)")).cast("double") / F.lit(float(SCALE))


def mean(amount: Column) -> Column:
    """Mean of a per-store or per-day group: one division of two exact integers."""
    u = units(amount)
    return ratio(F.sum(u), F.count(u))


def mean_when(condition: Column, amount: Column) -> Column:
    u = F.when(condition, units(amount))
    return ratio(F.sum(u), F.count(u))


def ratio(unit_sum: Column, count: Column) -> Column:
    return F.when(count > 0, unit_sum.cast("double") / (count * SCALE).cast("double"))
