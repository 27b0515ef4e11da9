"""Tail probabilities of the chi-squared and Student t distributions.

Spark has neither. Both run as pandas UDFs over *aggregated* rows (one row per test), by
the usual series and continued fractions of the incomplete gamma and beta functions.
"""

from __future__ import annotations

import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

# the helpers travel with the UDFs, whether or not executors have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TINY = 1e-300
_EPS = 1e-15


def gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function Q(a, x)."""
    if x <= 0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * _EPS:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1.0 - total * front)
    b = x + 1 - a
    c = 1 / _TINY
    d = 1 / b
    h = d
    for i in range(1, 100000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1 / (d if abs(d) > _TINY else _TINY)
        c = b + an / c
        c = c if abs(c) > _TINY else _TINY
        step = d * c
        h *= step
        if abs(step - 1) < _EPS:
            break
    return front * h


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_inc(b, a, 1 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    c = 1.0
    d = 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > _TINY else _TINY)
    h = d
    for m in range(1, 100000):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 + num * d
            d = 1 / (d if abs(d) > _TINY else _TINY)
            c = 1 + num / c
            c = c if abs(c) > _TINY else _TINY
            step = d * c
            h *= step
        if abs(step - 1) < _EPS:
            break
    return front * h / a


def chi2_tail(stat: float, dof: float) -> float:
    """P(chi-squared with ``dof`` degrees of freedom > stat); 1 for zero degrees."""
    return 1.0 if dof <= 0 else gamma_upper(dof / 2, stat / 2)


def t_tail(stat: float, dof: float) -> float:
    """P(T > stat) for Student's t."""
    half = 0.5 * beta_inc(dof / 2, 0.5, dof / (dof + stat * stat))
    return half if stat >= 0 else 1 - half


def _both(fn, stat: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series(
        [None if pd.isna(s) or pd.isna(d) else fn(float(s), float(d)) for s, d in zip(stat, dof)],
        dtype="float64",
    )


@F.pandas_udf(T.DoubleType())
def chi2_p(stat: pd.Series, dof: pd.Series) -> pd.Series:
    return _both(chi2_tail, stat, dof)


@F.pandas_udf(T.DoubleType())
def student_p(stat: pd.Series, dof: pd.Series) -> pd.Series:
    return _both(t_tail, stat, dof)
