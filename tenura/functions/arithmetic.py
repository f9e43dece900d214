"""Guarded arithmetic on columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def ratio(numerator: Column | str, denominator: Column | str, plus: int = 0) -> Column:
    """``numerator / (denominator + plus)`` as double; null on a zero denominator."""
    below = _col(denominator) + plus if plus else _col(denominator)
    return _col(numerator).cast("double") / F.nullif(below, F.lit(0)).cast("double")


def mean_of(columns: Sequence[str]) -> Column:
    """Row-wise mean of several columns as double; null if any is null."""
    total = reduce(lambda a, b: a + b, [F.col(c) for c in columns])
    return total.cast("double") / F.lit(float(len(columns)))


def percent(part: Column | str, whole: Column | str) -> Column:
    """``part * 100 / whole`` as double; null on a zero whole."""
    return _col(part) * F.lit(100.0) / F.nullif(_col(whole), F.lit(0))


def logistic(score: Column) -> Column:
    """``1 / (1 + exp(-score))``."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))
