"""Small numeric helpers: bias corrections and the Student-t tail.

The t tail is evaluated per result row (one row per feature) inside a
vectorised pandas UDF; scipy is not needed.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType


def sample_skewness(g1: Column, n: Column) -> Column:
    """Bias-corrected skewness G1 from the population value g1."""
    return g1 * F.sqrt(n * (n - 1)) / (n - 2)


def sample_excess_kurtosis(g2: Column, n: Column) -> Column:
    """Bias-corrected excess kurtosis G2 from the population excess g2."""
    return (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)


def _betacf(a: float, b: float, x: float) -> float:
    """Continued fraction for the regularised incomplete beta (Lentz)."""
    tiny, eps = 1e-300, 3e-16
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 10000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < eps:
            break
    return h


def betainc_reg(a: float, b: float, x: float) -> float:
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbeta = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    front = math.exp(lbeta + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _betacf(a, b, x) / a
    return 1.0 - front * _betacf(b, a, 1.0 - x) / b


def t_two_sided_p(t: float, dof: float) -> float:
    """P(|T| >= |t|) for Student's t with ``dof`` degrees of freedom."""
    if t is None or dof is None or not np.isfinite(t) or not np.isfinite(dof) or dof <= 0:
        return float("nan")
    x = dof / (dof + t * t)
    return betainc_reg(dof / 2.0, 0.5, x)


@pandas_udf(DoubleType())
def t_pvalue(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([t_two_sided_p(a, b) if pd.notna(a) and pd.notna(b) else np.nan
                      for a, b in zip(t, dof)], dtype="float64")
