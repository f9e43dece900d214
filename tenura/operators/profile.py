"""Table profiles: per-column statistics, nulls, constants, what to drop."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.operators.aggregate import column_modes, duplicate_rows
from tenura.operators.columns import long_form, present, string_columns
from tenura.operators.distinct import bits_for_error, column_sketches, distinct_counts, facts, merged_profile
from tenura.session import settle


def _levels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, n) with nulls as a level of their own.

    Counts combine before the shuffle, so a constant column sends one row per task.
    """
    long = long_form(df, columns, dtype="string")
    return long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


def schema_profile(df: DataFrame, order: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: type, non-null and null counts, exact distinct count, first value.

    ``order`` is the column that decides which row counts as the first one; of several
    first rows the smallest by all columns. NaN counts as null. Constant columns are
    known from their least and greatest value; of the others only digests are shuffled.
    """
    columns = list(columns or df.columns)
    known = settle(facts(df, columns, order))
    per_column = known.join(distinct_counts(df, columns, known), "feature", "left")
    nulls = F.col("n_rows") - F.col("non_null")
    return per_column.select(
        F.col("feature").alias("column_name"),
        "dtype",
        "non_null",
        nulls.alias("null_count"),
        F.round(nulls * 100.0 / F.col("n_rows"), 2).cast("double").alias("null_pct"),
        F.coalesce("n_unique", F.lit(0)).alias("n_unique"), F.col("first").alias("sample_value"),
    )


def schema_profile_approx(df: DataFrame, columns: Sequence[str] | None = None, rsd: float = 0.01) -> DataFrame:
    """:func:`schema_profile` with sketched distinct counts: one scan, nothing but sketches shuffled."""
    told = merged_profile(column_sketches(df, list(columns or df.columns), "all", bits_for_error(rsd)))
    return told.select(F.col("feature").alias("column_name"), "dtype", "non_null", "null_count", "n_unique")


def null_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls, NaN among them, per column and in total, one pass."""
    columns = list(columns or df.columns)
    counted = df.agg(*[F.count_if(present(df, c).isNull()).alias(c) for c in columns])
    long = counted.unpivot([], columns, "column_name", "null_count")
    return long.withColumn("total_nulls", counted.select(sum(F.col(c) for c in columns)).scalar())


def _column_reasons(df: DataFrame, columns: Sequence[str], share: float) -> DataFrame:
    """feature, n_unique, reason (null: none) and the most frequent value of columns with a reason.

    A pass for least, greatest and counts, one for distinct digests of what varies, and one that
    counts both values of the two-valued texts; no value is shuffled.
    """
    known = settle(facts(df, columns))
    counted = settle(known.join(distinct_counts(df, columns, known), "feature"))
    # one row per column
    pairs = [(r.feature, r.low, r.high) for r in counted.filter("n_unique = 2").collect() if r.feature in string_columns(df)]
    cells = [
        F.struct(F.lit(c).alias("feature"), F.count_if(F.col(c) == low).alias("lows"), F.count_if(F.col(c) == high).alias("highs"))
        for c, low, high in pairs
    ]
    none = df.sparkSession.createDataFrame([], "feature string, lows long, highs long")
    halves = df.agg(F.array(*cells).alias("cells")).select(F.inline("cells")) if cells else none
    rare = F.least("lows", "highs") / F.col("n_rows") < share
    reason = F.when(F.col("n_unique") <= 1, "constant").when(F.col("lows").isNotNull() & rare, "near-constant")
    return counted.join(halves, "feature", "left").select(
        "feature", "n_unique", reason.alias("reason"), F.when(F.col("highs") > F.col("lows"), F.col("high")).otherwise(F.col("low")).alias("value")
    )


def constant_columns(df: DataFrame, share: float, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with at most one value, or two-valued text whose minority is rarer than ``share``."""
    told = _column_reasons(df, list(columns or df.columns), share).filter(F.col("reason").isNotNull())
    return told.select(F.col("feature").alias("column_name"), "n_unique", "reason", "value")


def distinct_levels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct values (nulls included) of named columns, with counts."""
    return _levels(df, columns).select(F.col("feature").alias("column_name"), "value", "n")


def drop_plan(df: DataFrame, share: float, id_columns: Sequence[str],
              columns: Sequence[str] | None = None) -> DataFrame:
    """Columns to drop with the reason, distinct count and most frequent value."""
    columns = list(columns or df.columns)
    told = settle(_column_reasons(df, columns, share))
    # one row per column: only ids that nothing else drops have to be searched for their mode
    ids = [r.feature for r in told.filter(F.col("reason").isNull()).collect() if r.feature in id_columns]
    plain = told.filter(F.col("reason").isNotNull()).select(F.col("feature").alias("column_name"), "n_unique", "reason", F.col("value").alias("mode"))
    if not ids:
        return plain
    modes = column_modes(df, ids).select("feature", "mode")
    named = told.join(modes, "feature").select(F.col("feature").alias("column_name"), "n_unique", F.lit("id").alias("reason"), "mode")
    return plain.unionByName(named)


def dataset_profile(df: DataFrame, flag: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, columns, nulls, duplicates, class balance and the majority baseline, as one row."""
    columns = list(columns or [c for c in df.columns if c != flag])
    nulls = sum(F.count_if(present(df, c).isNull()) for c in columns)
    positive = F.sum(flag)
    rows = F.count(F.lit(1))
    one = df.agg(
        rows.alias("n_rows"),
        F.lit(len(columns)).cast("bigint").alias("n_columns"),
        nulls.alias("n_nulls"),
        positive.alias("n_positive"),
        (rows - positive).alias("n_negative"),
        (F.avg(flag) * 100).alias("positive_pct"),
        (F.lit(100.0) - F.avg(flag) * 100).alias("majority_pct"),
    )
    return one.withColumn("n_duplicates", duplicate_rows(df.select(*columns)).scalar())
