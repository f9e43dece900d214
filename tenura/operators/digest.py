"""Typed digests of cells and rows.

A cell becomes a text that tells apart what is different and nothing else: its kind of
null, zeros of either sign as one, any NaN as one, timestamps to the microsecond, and
the members of nested types one by one, each after its length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NULL = "-"


def _framed(text: Column) -> Column:
    """A text after its length, so that neighbours can't run into each other."""
    return F.concat(F.length(text).cast("string"), F.lit(":"), text)


def plain_text(column: Column, kind: T.DataType) -> Column:
    """A cell that is not null, as text."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(F.isnan(column), "NaN").when(column == 0, "0.0").otherwise(column.cast("string"))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(column)
    if isinstance(kind, T.ArrayType):
        return F.concat(F.size(column).cast("string"), F.lit("["), F.array_join(F.transform(column, lambda x: cell_text(x, kind.elementType)), ""))
    if isinstance(kind, T.MapType):
        entries = F.transform(F.map_entries(column), lambda e: F.concat(cell_text(e.key, kind.keyType), cell_text(e.value, kind.valueType)))
        return F.concat(F.size(entries).cast("string"), F.lit("{"), F.array_join(F.array_sort(entries), ""))
    if isinstance(kind, T.StructType):
        return F.concat(*[cell_text(column[f.name], f.dataType) for f in kind.fields])
    return column.cast("string")


def cell_text(column: Column, kind: T.DataType) -> Column:
    """The framed text of a cell; null has a mark that no value has."""
    return F.when(column.isNull(), F.lit(_NULL)).otherwise(_framed(plain_text(column, kind)))


def cell_digest(df: DataFrame, name: str) -> Column:
    """128 bits of one cell; null for null and NaN."""
    kind = df.schema[name].dataType
    column = F.col(name)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        column = F.nanvl(column, F.lit(None).cast(kind))
    return F.when(column.isNotNull(), F.unhex(F.md5(plain_text(column, kind).cast("binary"))))


def row_digest(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """256 bits of the named cells (default: all) in their order."""
    names = list(columns or df.columns)
    return F.unhex(F.sha2(F.concat(*[cell_text(F.col(c), df.schema[c].dataType) for c in names]), 256))
