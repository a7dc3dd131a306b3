"""Upper tails of the test distributions, for the handful of statistics a run ends in.

Series and continued fractions from the standard references; the tail itself is computed, never one
minus the distribution function, so values far below 1e-16 keep their precision.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TINY = 1e-300
_STEPS = 500


def normal_upper(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def _lentz(first: float, terms) -> float:
    """Value of first + a1/(b1 + a2/(b2 + ...)) by the modified Lentz method."""
    value = first or _TINY
    c, d = value, 0.0
    for a, b in terms:
        d = b + a * d
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = b + a / c
        c = c if abs(c) > _TINY else _TINY
        step = c * d
        value *= step
        if abs(step - 1.0) < 1e-15:
            break
    return value


def chi2_upper(x: float, dof: float) -> float:
    """Regularised upper incomplete gamma at (dof/2, x/2)."""
    if dof <= 0:
        return 1.0
    if x <= 0:
        return 1.0
    a, y = dof / 2.0, x / 2.0
    scale = math.exp(a * math.log(y) - y - math.lgamma(a))
    if y < a + 1:
        term = total = 1.0 / a
        for n in range(1, _STEPS):
            term *= y / (a + n)
            total += term
            if term < total * 1e-16:
                break
        return 1.0 - total * scale
    terms = ((-n * (n - a), y + 2 * n + 1 - a) for n in range(1, _STEPS))
    return scale / _lentz(y + 1 - a, terms)


def beta_lower(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_lower(1.0 - x, b, a)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )

    def terms():
        yield 1.0, 1.0
        for m in range(1, _STEPS):
            yield -(a + m - 1) * (a + b + m - 1) * x / ((a + 2 * m - 2) * (a + 2 * m - 1)), 1.0
            yield m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0

    return front / a * _lentz(0.0, terms())


def f_upper(f: float, d1: float, d2: float) -> float:
    if f <= 0:
        return 1.0
    return beta_lower(d2 / (d2 + d1 * f), d2 / 2.0, d1 / 2.0)


def t_two_sided(t: float, dof: float) -> float:
    return beta_lower(dof / (dof + t * t), dof / 2.0, 0.5)


def _apply(fn, *columns: pd.Series) -> pd.Series:
    return pd.Series([None if any(pd.isna(v) for v in row) else fn(*row) for row in zip(*columns, strict=True)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def normal_upper_p(z: pd.Series) -> pd.Series:
    return _apply(normal_upper, z)


@F.pandas_udf(T.DoubleType())
def chi2_upper_p(x: pd.Series, dof: pd.Series) -> pd.Series:
    return _apply(chi2_upper, x, dof)


@F.pandas_udf(T.DoubleType())
def f_upper_p(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return _apply(f_upper, f, d1, d2)


@F.pandas_udf(T.DoubleType())
def t_two_sided_p(t: pd.Series, dof: pd.Series) -> pd.Series:
    return _apply(t_two_sided, t, dof)
