"""Tail probabilities of Student's t and Fisher's F, evaluated on already aggregated rows."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def log_beta(a: float, b: float) -> float:
    small, large = min(a, b), max(a, b)
    if large < 1e5:
        return math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)
    # difference of two huge log-gammas by Stirling's series, free of cancellation
    rise = (
        (large + small - 0.5) * math.log1p(small / large)
        + small * math.log(large)
        - small
        + 1 / (12 * (large + small))
        - 1 / (12 * large)
    )
    return math.lgamma(small) - rise


def regularized_beta(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function by its continued fraction (modified Lentz)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - regularized_beta(1.0 - x, b, a)
    log_front = a * math.log(x) + b * math.log1p(-x) - log_beta(a, b) - math.log(a)
    if log_front < -745.0:
        return 0.0
    tiny = 1e-300
    value, c, d = 1.0, 1.0, 0.0
    for step in range(int(1000 + 20 * math.sqrt(max(a, b)))):
        m = step // 2
        if step == 0:
            term = 1.0
        elif step % 2 == 0:
            term = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            term = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1.0 + term * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + term / c
        c = c if abs(c) > tiny else tiny
        value *= c * d
        if step > 0 and abs(1.0 - c * d) < 1e-15:
            break
    return math.exp(log_front) * (value - 1.0)


def t_two_sided(t: float, df: float) -> float:
    """P(|T| >= |t|) for Student's t."""
    if math.isnan(t) or math.isnan(df):
        return math.nan
    if math.isinf(t):
        return 0.0
    return regularized_beta(df / (df + t * t), df / 2, 0.5)


def f_upper(f: float, df1: float, df2: float) -> float:
    """P(F' >= f) for Fisher's F."""
    if math.isnan(f):
        return math.nan
    if math.isinf(f):
        return 0.0
    return regularized_beta(df2 / (df2 + df1 * f), df2 / 2, df1 / 2)


@F.pandas_udf(DoubleType())
def _t_tail(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([t_two_sided(a, b) for a, b in zip(t, df)], dtype="float64")


@F.pandas_udf(DoubleType())
def _f_tail(f: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
    return pd.Series([f_upper(a, b, c) for a, b, c in zip(f, df1, df2)], dtype="float64")


def t_p_value(t: Column, df: Column) -> Column:
    return F.when(t.isNotNull(), _t_tail(t, df))


def f_p_value(f: Column, df1: Column, df2: Column) -> Column:
    return F.when(f.isNotNull(), _f_tail(f, df1.cast("double"), df2.cast("double")))
