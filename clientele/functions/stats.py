"""Tail probabilities for already aggregated rows, and normal quantiles.

Neither Spark nor the SQL dialects have the Student t distribution. The UDFs
below see one row per experiment, never the observations.
"""

from __future__ import annotations

import math
import sys
from statistics import NormalDist

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Ship the helpers inside the UDFs: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Degrees of freedom from which the t distribution is taken as normal: they differ by less than 1e-7.
NORMAL_FROM = 1e7


def normal_quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)


def _beta_fraction(a: float, b: float, x: float) -> float:
    """The continued fraction of the incomplete beta function, evaluated by Lentz."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 20_000):  # the square root of the larger parameter is needed
        for term in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + term * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + term / c
            c = c if abs(c) > tiny else tiny
            value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            return value
    raise ArithmeticError(f"no convergence of the incomplete beta function at {a}, {b}, {x}")


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    log_front = (
        math.lgamma(a + b)
        - math.lgamma(a)
        - math.lgamma(b)
        + a * math.log(x)
        + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(log_front) * _beta_fraction(a, b, x) / a
    return 1.0 - math.exp(log_front) * _beta_fraction(b, a, 1.0 - x) / b


def t_two_sided(t: float, dof: float) -> float:
    if dof > NORMAL_FROM:
        return math.erfc(abs(t) / math.sqrt(2.0))
    return incomplete_beta(dof / 2.0, 0.5, dof / (dof + t * t))


def t_cdf(t: float, dof: float) -> float:
    tail = t_two_sided(t, dof) / 2.0
    return 1.0 - tail if t > 0 else tail


def t_quantile(p: float, dof: float) -> float:
    """Inverse of ``t_cdf`` by bisection."""
    if p < 0.5:
        return -t_quantile(1.0 - p, dof)
    low, high = 0.0, 1.0
    while t_cdf(high, dof) < p:
        high *= 2.0
    for _ in range(200):
        middle = (low + high) / 2.0
        if t_cdf(middle, dof) < p:
            low = middle
        else:
            high = middle
    return (low + high) / 2.0


def chi_square_tail(x: float) -> float:
    """Upper tail with one degree of freedom."""
    return math.erfc(math.sqrt(max(x, 0.0) / 2.0))


def _pairwise(function, first: pd.Series, second: pd.Series) -> pd.Series:
    return pd.Series(
        [
            function(a, b) if pd.notna(a) and pd.notna(b) else None
            for a, b in zip(first, second)
        ],
        dtype="float64",
    )


@F.pandas_udf(DoubleType())
def t_two_sided_udf(t: pd.Series, dof: pd.Series) -> pd.Series:
    return _pairwise(t_two_sided, t, dof)


@F.pandas_udf(DoubleType())
def t_cdf_udf(t: pd.Series, dof: pd.Series) -> pd.Series:
    return _pairwise(t_cdf, t, dof)


@F.pandas_udf(DoubleType())
def t_quantile_udf(p: pd.Series, dof: pd.Series) -> pd.Series:
    return _pairwise(t_quantile, p, dof)


@F.pandas_udf(DoubleType())
def chi_square_tail_udf(x: pd.Series) -> pd.Series:
    return pd.Series([chi_square_tail(v) if pd.notna(v) else None for v in x], dtype="float64")
