"""Column-level operators: names, types, null filling, row filters."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed value: characters a table column name may not hold
_BAD_NAME = re.compile(r"[ ,;{}()\n\t=\-]")


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Replace characters that tables refuse in column names by ``_``."""
    return df.toDF(*[_BAD_NAME.sub("_", name) for name in df.columns])


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*names)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in exclude
    ]


def column_kinds(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """One row per column: position, name, type, numeric / string / other."""
    numeric, text = numeric_columns(df), string_columns(df)
    rows = [
        (i, f.name, f.dataType.simpleString(),
         "numeric" if f.name in numeric else "string" if f.name in text else "other",
         f.name in exclude)
        for i, f in enumerate(df.schema.fields, 1)
    ]
    schema = "position int, column_name string, dtype string, kind string, excluded boolean"
    return df.sparkSession.createDataFrame(rows, schema)


def fill_nulls(df: DataFrame, columns: Sequence[str], value: float = 0) -> DataFrame:
    return df.na.fill(value, list(columns))


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without a null in any of the columns."""
    return df.na.drop(subset=list(columns))


def with_flag(df: DataFrame, name: str, column: str, positive: object) -> DataFrame:
    """Adds a 0/1 flag column; null counts as 0."""
    return df.withColumn(name, F.when(F.col(column) == F.lit(positive), 1).otherwise(0))


def without_nan(column: Column) -> Column:
    """A double in which NaN is missing, as null is."""
    return F.nanvl(column.cast("double"), F.lit(None).cast("double"))


def present(df: DataFrame, name: str) -> Column:
    """The column in its own type, NaN as null where it can hold one."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.nanvl(F.col(name), F.lit(None).cast(kind)).alias(name)
    return F.col(name)


def long_form(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (),
              dtype: str = "double", feature: str = "feature", value: str = "value") -> DataFrame:
    """One row per (row, column), values cast to one type; nulls kept, and NaN becomes null."""
    cast = df.select(*keep, *[present(df, c).cast(dtype).alias(c) for c in columns])
    if dtype == "double":  # a text may say NaN, too
        cast = cast.select(*keep, *[without_nan(F.col(c)).alias(c) for c in columns])
    return cast.unpivot(list(keep), list(columns), feature, value)
