"""Tail probabilities as vectorised column functions (numpy only)."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _log_gamma(x: np.ndarray) -> np.ndarray:
    return np.vectorize(math.lgamma, otypes=[float])(x)


#: Relative change of a value below which it is settled.
SETTLED = 4e-15


def _most_rounds(*sizes: np.ndarray) -> int:
    """Rounds after which an unsettled value is an error; the need grows with the root of the size."""
    largest = max((float(s[np.isfinite(s)].max(initial=1.0)) for s in sizes), default=1.0)
    return 1000 + int(100 * math.sqrt(largest))


def beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function (Lentz's method), each value until it is settled."""
    out, going = np.empty_like(x), np.arange(len(x))
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1 - (a + b) * x / (a + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, _most_rounds(a, b)):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 + num * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + num / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            h = h * d * c
        open_ = np.abs(d * c - 1) > SETTLED
        if 2 * np.count_nonzero(open_) <= len(going):  # the settled ones leave together
            out[going[~open_]] = h[~open_]
            going, a, b, x, c, d, h = (v[open_] for v in (going, a, b, x, c, d, h))
            if not len(going):
                return out
    raise ArithmeticError("incomplete beta function not settled")


def incomplete_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta function I_x(a, b)."""
    x = np.clip(x, 0.0, 1.0)
    inside = np.clip(x, 1e-300, 1 - 1e-16)
    front = np.exp(
        _log_gamma(a + b) - _log_gamma(a) - _log_gamma(b) + a * np.log(inside) + b * np.log1p(-inside)
    )
    low = x < (a + 1) / (a + b + 2)
    # each value's tail that settles fast: the one asked for, or what is left to one
    near = np.where(low, a, b)
    tail = front * beta_fraction(near, np.where(low, b, a), np.where(low, inside, 1 - inside)) / near
    return np.where(x <= 0, 0.0, np.where(x >= 1, 1.0, np.where(low, tail, 1 - tail)))


def _gamma_series(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Power series of the lower incomplete gamma function, for x < a + 1."""
    term = 1 / a
    total = term.copy()
    for n in range(1, _most_rounds(a)):
        term = term * x / (a + n)
        total = total + term
        if not np.any(term > SETTLED / 100 * total):
            return total
    raise ArithmeticError("incomplete gamma function not settled")


def _gamma_fraction(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the upper incomplete gamma function, for x >= a + 1."""
    tiny = 1e-300
    b = x + 1 - a
    c = np.full_like(x, 1 / tiny)
    d = 1 / np.where(np.abs(b) < tiny, tiny, b)
    h = d.copy()
    for i in range(1, _most_rounds(a)):
        an = -i * (i - a)
        b = b + 2
        d = an * d + b
        d = 1 / np.where(np.abs(d) < tiny, tiny, d)
        c = b + an / c
        c = np.where(np.abs(c) < tiny, tiny, c)
        h = h * d * c
        if not np.any(np.abs(d * c - 1) > SETTLED):
            return h
    raise ArithmeticError("incomplete gamma function not settled")


def gamma_upper(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised upper incomplete gamma function Q(a, x)."""
    a = np.where(np.isfinite(a), a, 1.0)
    safe = np.where(np.isnan(x), 1.0, np.clip(x, 1e-300, 1e300))
    low = safe < a + 1
    front = np.exp(a * np.log(safe) - safe - _log_gamma(a))
    out = np.empty_like(safe)
    out[low] = 1 - front[low] * _gamma_series(a[low], safe[low])
    out[~low] = front[~low] * _gamma_fraction(a[~low], safe[~low])
    return np.where(x <= 0, 1.0, np.clip(out, 0.0, 1.0))


def t_p(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    with np.errstate(all="ignore"):
        p = incomplete_beta(df / 2, np.full_like(df, 0.5), df / (df + t * t))
    return np.where(np.isnan(t) | np.isnan(df), np.nan, p)


def normal_p(z: np.ndarray) -> np.ndarray:
    return np.vectorize(lambda v: math.erfc(abs(v) / math.sqrt(2.0)), otypes=[float])(z)


def chi2_p(stat: np.ndarray, df: np.ndarray) -> np.ndarray:
    with np.errstate(all="ignore"):
        p = gamma_upper(np.maximum(df, 1e-9) / 2, stat / 2)
    return np.where(np.isnan(stat) | (df <= 0), np.nan, p)


def _nullable(values: np.ndarray) -> pd.Series:
    return pd.Series(values).where(~np.isnan(values), None).astype("float64")


@F.pandas_udf(DoubleType())
def two_sided_t(t: pd.Series, df: pd.Series) -> pd.Series:
    return _nullable(t_p(t.to_numpy("float64"), df.to_numpy("float64")))


@F.pandas_udf(DoubleType())
def two_sided_normal(z: pd.Series) -> pd.Series:
    return _nullable(normal_p(z.to_numpy("float64")))


@F.pandas_udf(DoubleType())
def chi2_tail(stat: pd.Series, df: pd.Series) -> pd.Series:
    return _nullable(chi2_p(stat.to_numpy("float64"), df.to_numpy("float64")))
