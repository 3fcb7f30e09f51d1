"""Tail probabilities of Student's t and Fisher's F as Arrow-batched pandas
UDFs (Spark SQL has no distribution functions). Small numeric helpers: the
regularised incomplete beta function by Lentz's continued fraction,
vectorised with numpy."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_LGAMMA = np.frompyfunc(math.lgamma, 1, 1)


def _betacf(a: np.ndarray, b: np.ndarray, x: np.ndarray, iters: int = 300,
            eps: float = 1e-15) -> np.ndarray:
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c = np.ones_like(x)
    d = 1.0 - qab * x / qap
    d = np.where(np.abs(d) < tiny, tiny, d)
    d = 1.0 / d
    h = d.copy()
    for m in range(1, iters + 1):
        m2 = 2.0 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < tiny, tiny, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < tiny, tiny, c)
        d = 1.0 / d
        h = h * d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < tiny, tiny, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < tiny, tiny, c)
        d = 1.0 / d
        delta = d * c
        h = h * delta
        if np.all(np.abs(delta - 1.0) < eps):
            break
    return h


def betainc_regularized(a, b, x) -> np.ndarray:
    """I_x(a, b) for arrays of a, b > 0 and 0 <= x <= 1 (NaN elsewhere)."""
    a, b, x = (np.asarray(v, dtype=float) for v in (a, b, x))
    a, b, x = np.broadcast_arrays(a, b, x)
    out = np.full(x.shape, np.nan)
    ok = (a > 0) & (b > 0) & (x >= 0) & (x <= 1)
    if not ok.any():
        return out
    aa, bb, xx = a[ok], b[ok], x[ok]
    with np.errstate(divide="ignore", invalid="ignore"):
        lbeta = (_LGAMMA(aa + bb) - _LGAMMA(aa) - _LGAMMA(bb)).astype(float)
        front = np.exp(lbeta + aa * np.log(xx) + bb * np.log1p(-xx))
        direct = xx < (aa + 1.0) / (aa + bb + 2.0)
        res = np.empty_like(xx)
        if direct.any():
            res[direct] = front[direct] * _betacf(aa[direct], bb[direct], xx[direct]) / aa[direct]
        flip = ~direct
        if flip.any():
            res[flip] = 1.0 - front[flip] * _betacf(bb[flip], aa[flip], 1.0 - xx[flip]) / bb[flip]
    res = np.where(xx == 0, 0.0, np.where(xx == 1, 1.0, res))
    out[ok] = res
    return out


def t_two_sided_p(t, df) -> np.ndarray:
    """P(|T_df| >= |t|)."""
    t, df = np.asarray(t, dtype=float), np.asarray(df, dtype=float)
    return betainc_regularized(df / 2.0, 0.5, df / (df + t * t))


def f_upper_p(f, d1, d2) -> np.ndarray:
    """P(F_{d1,d2} >= f)."""
    f, d1, d2 = (np.asarray(v, dtype=float) for v in (f, d1, d2))
    return betainc_regularized(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


@F.pandas_udf(DoubleType())
def _t_p_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(t_two_sided_p(t.to_numpy(float), df.to_numpy(float)))


@F.pandas_udf(DoubleType())
def _f_p_udf(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series(f_upper_p(f.to_numpy(float), d1.to_numpy(float), d2.to_numpy(float)))


def t_test_p(t: Column, df: Column) -> Column:
    """Two-sided p-value of a t statistic with ``df`` degrees of freedom."""
    return _t_p_udf(t.cast("double"), df.cast("double"))


def f_test_p(f: Column, d1: Column, d2: Column) -> Column:
    """Upper-tail p-value of an F statistic."""
    return _f_p_udf(f.cast("double"), d1.cast("double"), d2.cast("double"))
