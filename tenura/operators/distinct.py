"""Distinct counts: exact by digests, and mergeable sketches kept per load."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura.operators.columns import present
from tenura.operators.digest import cell_digest, plain_text
from tenura.session import settle

#: 2 ** 14 registers a sketch: a standard error of 0.8 %, 16 KB at most.
SKETCH_BITS = 14
_UNORDERED = (T.MapType, T.VariantType)


def facts(df: DataFrame, columns: Sequence[str], order: str | None = None) -> DataFrame:
    """feature, dtype, n_rows, non_null, constant, low, high, first in one pass; NaN is missing.

    ``constant`` says that there is at most one different value, which is what the least
    and the greatest decide; ``low`` and ``high`` are those two as text. ``first`` is the value, as
    text, in the first row by ``order``; of several such rows the smallest by the columns in turn.
    """
    cells, rows, firsts = [], [], []
    if order is not None:
        ordered = [c for c in columns if not isinstance(df.schema[c].dataType, _UNORDERED)]
        rows = [F.min(F.when(F.col(order).isNotNull(), F.struct(F.col(order).alias("_order"), *ordered))).alias("first")]
    for name in columns:
        kind, x = df.schema[name].dataType, present(df, name)
        # what has no order is compared by its digest
        key = cell_digest(df, name) if isinstance(kind, _UNORDERED) else x
        low, high = F.min(key), F.max(key)
        told = F.col(f"first.{name}") if rows and name in ordered else F.lit(None)
        told = F.nanvl(told, F.lit(None).cast(kind)) if isinstance(kind, (T.DoubleType, T.FloatType)) and rows else told
        firsts.append(told.cast("string"))
        cells.append(F.struct(
            F.lit(name).alias("feature"), F.lit(kind.simpleString()).alias("dtype"), F.count(F.lit(1)).alias("n_rows"),
            F.count(x).alias("non_null"), F.coalesce(low == high, F.lit(True)).alias("constant"),
            low.cast("string").alias("low"), high.cast("string").alias("high"),
        ))
    one = df.agg(F.array(*cells).alias("cells"), *rows)
    return one.select(F.inline(F.arrays_zip("cells", F.array(*firsts).alias("first")))).select("cells.*", "first")


def distinct_counts(df: DataFrame, columns: Sequence[str], known: DataFrame | None = None) -> DataFrame:
    """feature, n_unique: exact counts of the non-null values (NaN is missing).

    A column whose least value is its greatest has one, or none, and sends nothing. Of the
    others 128-bit digests are combined in each task and counted after the shuffle; no
    value crosses it. ``known`` is a written :func:`facts` of the same columns.
    """
    told = settle(facts(df, columns)) if known is None else known
    # one row per column
    varied = [r.feature for r in told.filter(~F.col("constant")).select("feature").collect()]
    single = told.filter("constant").select("feature", F.least("non_null", F.lit(1)).cast("long").alias("n_unique"))
    if not varied:
        return single
    digests = df.select(*[cell_digest(df, c).alias(c) for c in varied]).unpivot([], varied, "feature", "digest")
    different = digests.filter(F.col("digest").isNotNull()).groupBy("feature", "digest").agg(F.lit(1).alias("one"))
    return single.unionByName(different.groupBy("feature").agg(F.count(F.lit(1)).alias("n_unique")))


def _sketched(df: DataFrame, name: str, bits: int) -> Column:
    """The sketch of a column's values; NaN is missing, and zeros of both signs are one value."""
    kind, x = df.schema[name].dataType, present(df, name)
    if isinstance(kind, T.IntegralType):
        x = F.col(name).cast("long")
    elif not isinstance(kind, (T.StringType, T.BinaryType)):
        x = F.when(x.isNotNull(), plain_text(x, kind))
    return F.hll_sketch_agg(x, bits)


def column_sketches(df: DataFrame, columns: Sequence[str], load: str, bits: int = SKETCH_BITS) -> DataFrame:
    """load, feature, dtype, n_rows, non_null, sketch: all that later profiles need of this load.

    One pass; only counts and sketches are shuffled. Append it to a table: old rows
    are not read again.
    """
    cells = [
        F.struct(
            F.lit(load).alias("load"), F.lit(name).alias("feature"), F.lit(df.schema[name].dataType.simpleString()).alias("dtype"),
            F.count(F.lit(1)).alias("n_rows"), F.count(present(df, name)).alias("non_null"),
            _sketched(df, name, bits).alias("sketch"),
        )
        for name in columns
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def merged_profile(sketches: DataFrame) -> DataFrame:
    """feature, dtype, n_loads, n_rows, non_null, null_count, n_unique of all loads, from their sketches alone."""
    return sketches.groupBy("feature", "dtype").agg(
        F.count(F.lit(1)).alias("n_loads"), F.sum("n_rows").alias("n_rows"), F.sum("non_null").alias("non_null"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_unique"),
    ).withColumn("null_count", F.col("n_rows") - F.col("non_null"))


def bits_for_error(rsd: float) -> int:
    """Least sketch bits for a relative standard error."""
    return min(21, max(4, math.ceil(2 * math.log2(1.04 / rsd))))


def sketch_error(bits: int = SKETCH_BITS, deviations: float = 4.0) -> float:
    """Relative error that a sketched count stays within, but for one case in ten thousand."""
    return deviations * 1.04 / math.sqrt(2**bits)
