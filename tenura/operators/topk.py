"""Sorting, limits and best rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sort_report(df: DataFrame, *order: str | Column) -> DataFrame:
    """Totally ordered report (range-partitioned sort)."""
    return df.orderBy(*order)


def top_k(df: DataFrame, k: int, *order: str | Column) -> DataFrame:
    """First k rows in ``order``: each task keeps k rows, only those are merged."""
    return df.orderBy(*order).limit(k)


def arg_max(df: DataFrame, metric: str, *ties: str | Column) -> DataFrame:
    """The row with the highest metric."""
    return top_k(df, 1, F.col(metric).desc_nulls_last(), *ties)


def preview(df: DataFrame, *order: str | Column, rows: int = 5) -> DataFrame:
    """A few rows; give an order to make the choice repeatable."""
    return top_k(df, rows, *order) if order else df.limit(rows)
