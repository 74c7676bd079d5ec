"""Upper tails of the test statistics.

The plain functions take one number; they are applied to statistics that are
already aggregated (one row per test), never to table rows.  The ``*_tail``
versions wrap them as Pandas UDFs so a test result stays a lazy DataFrame.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function Q(a, x)."""
    if x <= 0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-17:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1.0 - front * total)
    return front * _gamma_fraction(a, x)


def _gamma_fraction(a: float, x: float) -> float:
    """Lentz evaluation of the continued fraction of Q(a, x)."""
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    value = d
    for i in range(1, 100000):
        step = -i * (i - a)
        b += 2
        d = 1 / ((step * d + b) or tiny)
        c = (b + step / c) or tiny
        value *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return value


def _stirling_rest(z: float) -> float:
    """ln gamma(z) less Stirling's formula."""
    if z < 15:
        return math.lgamma(z) - (z - 0.5) * math.log(z) + z - 0.5 * math.log(2 * math.pi)
    s = 1 / (z * z)
    return (1 / 12 - (1 / 360 - (1 / 1260 - (1 / 1680 - s / 1188) * s) * s) * s) / z


def _deviance(x: float, over: float) -> float:
    """x ln(x / m) + m - x for m = x - ``over``, without cancellation when both are near."""
    m = x - over
    if abs(over) >= 0.1 * (x + m):
        return x * math.log(x / m) - over
    v = over / (x + m)
    total, term, k = over * v, 2 * x * v, 1
    while True:
        term *= v * v
        k += 2
        following = total + term / k
        if following == total:
            return total
        total = following


def beta_lower(a: float, b: float, x: float, rest: float | None = None) -> float:
    """Regularised incomplete beta function I_x(a, b); ``rest`` is 1 - x where the caller knows it better.

    The factor in front of the continued fraction is built from deviances and the errors of
    Stirling's formula, so it keeps its digits at any size of a and b.
    """
    y = 1 - x if rest is None else rest
    if x <= 0:
        return 0.0
    if y <= 0:
        return 1.0
    n = a + b
    over = a * y - b * x  # a less n x, which is also n y less b
    front = math.sqrt(a * b / (2 * math.pi * n)) * math.exp(
        _stirling_rest(n) - _stirling_rest(a) - _stirling_rest(b) - _deviance(a, over) - _deviance(b, -over))
    return front * _beta_fraction(a, b, x, y, over) if over > 0 else 1 - front * _beta_fraction(b, a, y, x, -over)


def _beta_fraction(a: float, b: float, x: float, y: float, over: float) -> float:
    """Lentz evaluation of the continued fraction of DiDonato and Morris (1992), whose terms hold a y - b x itself."""
    tiny = 1e-300
    value = c = tiny
    d, n = 0.0, 0
    while n < 10_000_000:
        top = 1.0 if n == 0 else (a + n - 1) / (a + 2 * n - 1) * ((a + b + n - 1) / (a + 2 * n - 1)) * n * (b - n) * x * x
        bottom = n + (a + n) * ((over + 1 + n * (1 + y)) / (a + 2 * n + 1))
        if n:
            bottom += n * (b - n) * x / (a + 2 * n - 1)
        d = 1 / ((bottom + top * d) or tiny)
        c = (bottom + top / c) or tiny
        value *= d * c
        if abs(d * c - 1) < 1e-16:
            break
        n += 1
    return value


def chi2_sf(x: float, dof: float) -> float:
    return gamma_upper(dof / 2, x / 2)


def f_sf(x: float, d1: float, d2: float) -> float:
    if x <= 0:
        return 1.0
    if math.isinf(x):
        return 0.0
    return beta_lower(d2 / 2, d1 / 2, d2 / (d2 + d1 * x), d1 * x / (d2 + d1 * x))


def t_sf2(t: float, dof: float) -> float:
    """Two-sided tail of Student's t."""
    return f_sf(t * t, 1, dof)


def normal_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def kolmogorov_sf(d: float, n: float) -> float:
    """Two-sided one-sample Kolmogorov-Smirnov tail.

    Small samples use the exact matrix power of Marsaglia, Tsang and Wang
    (2003); larger ones the limiting series with the finite-n argument of Vrbik (2018).
    """
    if d <= 0:
        return 1.0
    if d >= 1:
        return 0.0
    if n <= 400 and n * d * d < 12:
        return 1 - _kolmogorov_exact(d, int(n))
    z = d * math.sqrt(n)
    z += 1 / (6 * math.sqrt(n)) + (z - 1) / (4 * n)
    if z < 0.3:
        return 1.0
    return min(1.0, max(0.0, 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * z * z) for k in range(1, 101))))


def _kolmogorov_exact(d: float, n: int) -> float:
    import numpy as np

    k = int(n * d) + 1
    m = 2 * k - 1
    h = k - n * d
    row = np.arange(m)
    band = np.where(row[:, None] - row[None, :] + 1 < 0, 0.0, 1.0)
    for i in range(m):
        band[i, 0] -= h ** (i + 1)
        band[m - 1, i] -= h ** (m - i)
    band[m - 1, 0] += max(0.0, 2 * h - 1) ** m
    for i in range(m):
        for j in range(m):
            if i - j + 1 > 0:
                band[i, j] /= math.factorial(i - j + 1)
    power = np.linalg.matrix_power(band, n)
    return float(power[k - 1, k - 1] * math.exp(math.lgamma(n + 1) - n * math.log(n)))


def _null_safe(fn, *columns):
    return pd.Series([None if any(pd.isna(v) for v in row) else fn(*row) for row in zip(*columns)], dtype="float64")


@F.pandas_udf(DoubleType())
def chi2_tail(x: pd.Series, dof: pd.Series) -> pd.Series:
    return _null_safe(chi2_sf, x, dof)


@F.pandas_udf(DoubleType())
def f_tail(x: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return _null_safe(f_sf, x, d1, d2)


@F.pandas_udf(DoubleType())
def t_tail(t: pd.Series, dof: pd.Series) -> pd.Series:
    return _null_safe(t_sf2, t, dof)


@F.pandas_udf(DoubleType())
def kolmogorov_tail(d: pd.Series, n: pd.Series) -> pd.Series:
    return _null_safe(kolmogorov_sf, d, n)
