"""Tail probabilities for one-row-per-feature statistics.

Spark has no inverse or tail function of the t, chi-squared or normal law. The
statistics are computed by Spark; these vectorised functions only see the few
finished rows.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


# the few functions below travel with the plan: workers need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def normal_tail(z: float) -> float:
    """P(|Z| >= |z|)."""
    return math.erfc(abs(z) / math.sqrt(2.0))


def _stirling_rest(a: float) -> float:
    """log Gamma(a + 1) minus Stirling's (a + 1/2) log a - a + log sqrt(2 pi)."""
    if a < 16:
        return math.lgamma(a + 1) - (a + 0.5) * math.log(a) + a - 0.5 * math.log(2 * math.pi)
    q = 1 / (a * a)
    return (1 / 12 - (1 / 360 - (1 / 1260 - q / 1680) * q) * q) / a


def _log_excess(d: float) -> float:
    """d - log(1 + d), exact for small d, too."""
    if abs(d) > 0.1:
        return d - math.log1p(d)
    total, power, k = 0.0, d * d, 2
    while True:
        step = power / k if k % 2 == 0 else -power / k
        total += step
        if abs(step) <= 1e-17 * abs(total):
            return total
        power, k = power * d, k + 1


def _poisson_log(a: float, x: float) -> float:
    """log of x^a e^-x / Gamma(a + 1), without the loss of digits of the plain difference."""
    return -a * _log_excess((x - a) / a) - _stirling_rest(a) - 0.5 * math.log(2 * math.pi * a)


def gamma_tail(a: float, x: float) -> float:
    """The regularised upper incomplete gamma function, for any size of ``a``.

    Below a + 1 one minus the series, above it the continued fraction; both run until
    they stand still, which takes a multiple of sqrt(a) steps.
    """
    if x <= 0:
        return 1.0
    front = _poisson_log(a, x)
    if x < a + 1:
        term = total = 1.0
        k = a
        while term > 1e-17 * total:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1.0 - math.exp(front + math.log(total)))
    b = x + 1 - a
    c, d = 1e300, 1 / b
    value, k = d, 0
    while True:
        k += 1
        top = -k * (k - a)
        b += 2
        d = top * d + b
        d = 1 / (d if abs(d) > 1e-300 else 1e-300)
        c = b + top / c
        c = c if abs(c) > 1e-300 else 1e-300
        value *= c * d
        if abs(c * d - 1) < 1e-15:
            return min(1.0, math.exp(front + math.log(a) + math.log(value)))


def chi2_tail(x: float, dof: float) -> float:
    """P(X >= x)."""
    return 0.0 if math.isinf(x) else gamma_tail(dof / 2, x / 2)


def student_tail(t: float, dof: float) -> float:
    """P(|T| >= |t|): the regularised incomplete beta at dof / (dof + t^2)."""
    if dof <= 0:
        return float("nan")
    if math.isinf(t):
        return 0.0
    if t == 0:
        return 1.0
    a, q = dof / 2, t * t / dof
    log_q = 2 * math.log(abs(t)) - math.log(dof)  # the square of a tiny t is no longer a number
    ratio = _half_step(a)
    front = ratio - 0.5 * math.log(math.pi) - a * math.log1p(q) + 0.5 * (log_q - math.log1p(q))
    x, rest = 1 / (1 + q), q / (1 + q)
    # with many degrees of freedom the other side loses no digits while p is not tiny
    if x < (a + 1) / (a + 2.5) and not (a > 50 and t * t < 30):
        return min(1.0, math.exp(front) * _beta_fraction(a, 0.5, x) / a)
    return max(0.0, 1.0 - math.exp(front) * _beta_fraction(0.5, a, rest) / 0.5)


def _half_step(a: float) -> float:
    """log Gamma(a + 1/2) - log Gamma(a), by Stirling's rests where plain values lose digits."""
    if a < 32:
        return math.lgamma(a + 0.5) - math.lgamma(a)
    low, high = a - 1, a - 0.5
    return (low + 0.5) * math.log1p(0.5 / low) + 0.5 * math.log(high) - 0.5 + _stirling_rest(high) - _stirling_rest(low)


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, evaluated forwards until it stands still."""
    floor = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > floor else floor)
    value, m = d, 0
    while True:
        m += 1
        for top in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + top * d
            d = 1.0 / (d if abs(d) > floor else floor)
            c = 1.0 + top / c
            c = c if abs(c) > floor else floor
            step = c * d
            value *= step
        if abs(step - 1.0) < 1e-15:
            return value


#: Rows of the smaller sample up to which rank sums are counted exactly, and of the other one.
EXACT_ROWS, EXACT_OTHERS = 8, 1_000_000


def rank_sum_tail(u: float, m: int, n: int) -> float:
    """Two-sided exact P of U in samples of ``m`` and ``n`` rows without ties.

    Orders with U = k are the coefficient of q^k in the product of (1 - q^(n+i)) / (1 - q^i)
    over i = 1..m, with m the smaller sample; only the lower tail is needed, in whole numbers.
    """
    m, n = min(m, n), max(m, n)
    most = math.floor(min(u, m * n - u))
    ways = np.zeros(most + 1, object)
    ways[0] = 1
    for i in range(1, m + 1):
        if n + i <= most:
            ways[n + i :] = ways[n + i :] - ways[: most + 1 - n - i]
    for i in range(1, m + 1):
        for start in range(min(i, most + 1)):
            ways[start::i] = np.cumsum(ways[start::i])
    return min(1.0, 2 * sum(ways.tolist()) / math.comb(m + n, m))


@F.pandas_udf(DoubleType())
def rank_sum_p(u: pd.Series, m: pd.Series, n: pd.Series) -> pd.Series:
    """Exact p-values where the samples are within the bounds, else null."""

    def one(u: float, m: int, n: int) -> float:
        small = not pd.isna(u) and min(m, n) <= EXACT_ROWS and max(m, n) <= EXACT_OTHERS
        return rank_sum_tail(u, int(m), int(n)) if small and u == int(u) else float("nan")

    return pd.Series([one(*row) for row in zip(u, m, n)], dtype="float64")


@F.pandas_udf(DoubleType())
def normal_p(z: pd.Series) -> pd.Series:
    return z.map(lambda v: None if pd.isna(v) else normal_tail(v)).astype("float64")


@F.pandas_udf(DoubleType())
def chi2_p(x: pd.Series, dof: pd.Series) -> pd.Series:
    pairs = zip(x, dof)
    return pd.Series(
        [float("nan") if pd.isna(v) or pd.isna(k) or k < 1 else chi2_tail(v, float(k)) for v, k in pairs],
        dtype="float64",
    )


@F.pandas_udf(DoubleType())
def student_p(t: pd.Series, dof: pd.Series) -> pd.Series:
    pairs = zip(t, dof)
    return pd.Series(
        [float("nan") if pd.isna(v) or pd.isna(k) else student_tail(v, float(k)) for v, k in pairs],
        dtype="float64",
    )
