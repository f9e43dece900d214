"""Grouped aggregates, cuts, counts, pivots and histograms.

Every aggregate here combines before its shuffle, so a value that holds a third
of all rows costs one row per task, not a hot partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura.functions.arithmetic import percent
from tenura.operators.columns import long_form, numeric_columns, present
from tenura.operators.digest import row_digest
from tenura.operators.heavy import most_frequent
from tenura.operators.selection import first_counts, moments, radix_quantiles
from tenura.session import settle


def row_count(df: DataFrame) -> DataFrame:
    """Rows and columns, as one row."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("bigint")
    )


def metric_set(flag: str, averages: Mapping[str, str]) -> list[Column]:
    """Head count, flagged count, flagged percent and a mean per measure."""
    return [
        F.count(F.lit(1)).alias("total_employees"),
        F.sum(flag).alias("attrition_count"),
        (F.avg(flag) * 100).alias("attrition_rate"),
        *[F.avg(column).alias(name) for name, column in averages.items()],
    ]


def cut(df: DataFrame, name: str, value: Column, metrics: Sequence[Column]) -> DataFrame:
    """One cut in long form: (dimension_name, dimension_value, metrics)."""
    return (
        df.groupBy(value.cast("string").alias("dimension_value"))
        .agg(*metrics)
        .select(F.lit(name).alias("dimension_name"), "*")
    )


def cuts(df: DataFrame, dimensions: Mapping[str, Column], measures: Sequence[str],
         metrics: Sequence[Column]) -> DataFrame:
    """Many cuts in one scan and one aggregate.

    Each row is repeated per dimension inside the task and folded straight into
    the partial aggregate; only (tasks x values) rows are shuffled.
    """
    wide = df.select(
        *measures, *[value.cast("string").alias(f"_cut_{i}") for i, value in enumerate(dimensions.values())]
    )
    cells = [x for i, name in enumerate(dimensions) for x in (F.lit(name), F.col(f"_cut_{i}"))]
    long = F.stack(F.lit(len(dimensions)), *cells).alias("dimension_name", "dimension_value")
    return wide.select(*measures, long).groupBy("dimension_name", "dimension_value").agg(*metrics)


def rollup_means(df: DataFrame, fine: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Counts and sums per fine group, from which coarser means follow exactly."""
    return df.groupBy(*fine).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(m).alias(f"_sum_{m}") for m in measures],
        *[F.count(m).alias(f"_n_{m}") for m in measures],
    )


def means_from_rollup(rollup: DataFrame, key: str, means: Mapping[str, str], count: str) -> DataFrame:
    """Means and head count by ``key`` out of :func:`rollup_means`."""
    return rollup.groupBy(key).agg(
        *[(F.sum(f"_sum_{m}") / F.sum(f"_n_{m}")).alias(name) for name, m in means.items()],
        F.sum("_rows").alias(count),
    )


def group_means(df: DataFrame, key: str, means: Mapping[str, str], count: str) -> DataFrame:
    return df.groupBy(key).agg(
        *[F.avg(m).alias(name) for name, m in means.items()],
        F.count(F.lit(1)).alias(count),
    )


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def distinct_tuples(df: DataFrame, sets: Mapping[str, Sequence[str]]) -> DataFrame:
    """Distinct tuples of several column sets in one scan: (set_name, v1, v2, ...).

    Values are carried as strings; shorter tuples are padded with nulls.
    """
    width = max(len(columns) for columns in sets.values())

    def padded(name: str, columns: Sequence[str]) -> Column:
        cells = [F.col(c).cast("string") for c in columns]
        cells += [F.lit(None).cast("string")] * (width - len(columns))
        return F.struct(
            F.lit(name).alias("set_name"), *[cell.alias(f"v{i}") for i, cell in enumerate(cells, 1)]
        )

    rows = F.array(*[padded(name, columns) for name, columns in sets.items()])
    return df.select(F.inline(rows)).distinct()


def value_counts(df: DataFrame, column: str, dropna: bool = True) -> DataFrame:
    """Count and percent by value, the most frequent first; the rows are read once."""
    rows = df.filter(present(df, column).isNotNull()) if dropna else df
    counts = settle(rows.groupBy(column).agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", percent(F.col("n"), total)).orderBy(F.col("n").desc(), column)


def rates(df: DataFrame, columns: Sequence[str], flag: str, dropna: bool = True) -> DataFrame:
    """Mean of a 0/1 flag and row count by (feature, level), with the overall mean.

    All columns share one scan and one aggregate; the overall mean comes from the
    counts of one of them. ``position`` gives the report's order within a feature: the
    highest rate first.
    """
    long = long_form(df, columns, keep=[flag], dtype="string", value="level")
    counts = settle(
        long.groupBy("feature", "level").agg(F.sum(flag).alias("_hits"), F.count(flag).alias("n"))
    )
    whole = counts.filter(F.col("feature") == list(columns)[0])
    overall = whole.agg(F.sum("_hits") / F.nullif(F.sum("n"), F.lit(0))).scalar()
    table = counts.filter(F.col("level").isNotNull()) if dropna else counts
    rate = F.col("_hits") / F.nullif(F.col("n"), F.lit(0))
    place = F.row_number().over(Window.partitionBy("feature").orderBy(F.desc_nulls_last("rate"), "level"))
    return table.select("feature", "level", rate.alias("rate"), "n", overall.alias("overall_rate")).withColumn("position", place)


def worst_levels(rate_table: DataFrame) -> DataFrame:
    """Per feature the level with the highest rate, where it beats the overall rate.

    Ties go to the smallest level.
    """
    best = F.min(F.struct((-F.col("rate")).alias("r"), "level", "rate", "n", "overall_rate"))
    return (
        rate_table.groupBy("feature")
        .agg(best.alias("best"))
        .select("feature", "best.level", "best.rate", "best.n", "best.overall_rate")
        .filter(F.col("rate") > F.col("overall_rate"))
    )


def pivot_mean(df: DataFrame, row: str, column: str, levels: Mapping[object, str], value: Column) -> DataFrame:
    """Two-key mean, second key spread over named columns."""
    means = [F.avg(F.when(F.col(column) == F.lit(level), value)).alias(name) for level, name in levels.items()]
    return df.filter(F.col(row).isNotNull()).groupBy(row).agg(*means)


def pivot_median(df: DataFrame, row: str, column: str, levels: Mapping[object, str], value: str) -> DataFrame:
    """Two-key exact median, second key spread over named columns."""
    kept = df.filter(F.col(row).isNotNull() & F.col(column).isin(list(levels)))
    medians = radix_quantiles(kept, [value], {"median": 0.5}, by=[row, column])
    spread = [F.max(F.when(F.col(column) == F.lit(level), F.col("median"))).alias(name) for level, name in levels.items()]
    return medians.groupBy(row).agg(*spread)


def center_by_class(df: DataFrame, value: str, label: str) -> DataFrame:
    """Exact median, mean and count of a measure by class; null and NaN are no values."""
    rows = _measured(df, value, label)
    medians = radix_quantiles(rows, [value], {"median": 0.5}, by=[label], settled=True)
    means = rows.groupBy(label).agg(F.avg(value).alias("mean"))
    return medians.join(means, label).select(label, "median", "mean", "n")


def _measured(df: DataFrame, value: str, by: str) -> DataFrame:
    """The two columns, written, where both have a value; each pass over them reads no others."""
    return settle(df.select(by, present(df, value)).na.drop())


def median_gap(df: DataFrame, value: str, label: str, high: object, low: object) -> DataFrame:
    """Medians and means of two classes and their gaps (``high`` minus ``low``)."""
    centers = center_by_class(df, value, label)

    def of(level: object, column: str) -> Column:
        return F.max(F.when(F.col(label) == F.lit(level), F.col(column)))

    return centers.agg(
        of(high, "median").alias("median_high"),
        of(low, "median").alias("median_low"),
        (of(high, "median") - of(low, "median")).alias("median_gap"),
        of(high, "mean").alias("mean_high"),
        of(low, "mean").alias("mean_low"),
        (of(high, "mean") - of(low, "mean")).alias("mean_gap"),
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample std, min, exact quartiles and max per column.

    The numbers are written once; moments and quartiles come from counts by key prefix, refined
    where a quartile needs it, so no values are shuffled. Null and NaN are no values. A column without values
    has n = 0 and nulls; where infinities leave no mean or std, those are null. ``position``
    gives the report's order: the largest mean first.
    """
    numbers = settle(df.select(*[present(df, c).cast("double").alias(c) for c in columns]))
    counts = first_counts(numbers, columns)
    quartiles = radix_quantiles(numbers, columns, {"q25": 0.25, "q50": 0.5, "q75": 0.75}, settled=True, first=counts).drop("n")
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    # one row per column
    told = names.join(moments(counts).join(quartiles, "feature"), "feature", "left").select(
        "feature", F.coalesce("n", F.lit(0)).cast("long").alias("n"), "mean", "std", "min", "q25", "q50", "q75", "max"
    )
    return told.withColumn("position", F.row_number().over(Window.orderBy(F.desc_nulls_last("mean"), "feature")))


def describe_approx(df: DataFrame, columns: Sequence[str], accuracy: int = 10_000) -> DataFrame:
    """:func:`describe` with sketched quartiles: one scan, nothing but sketches shuffled."""
    long = long_form(df, columns).filter(F.col("value").isNotNull())
    q = F.percentile_approx("value", [0.25, 0.5, 0.75], accuracy)
    return long.groupBy("feature").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        q[0].alias("q25"), q[1].alias("q50"), q[2].alias("q75"),
        F.max("value").alias("max"),
    )


def histogram(df: DataFrame, columns: Sequence[str], by: str, bins: int) -> DataFrame:
    """Equal-width bins per (feature, class) over that class's own range.

    The last bin is closed; a single-valued range is widened by half on each side, or
    by as much as a large value needs to differ; empty bins are kept, and without any
    value they have no edges. ``density`` is count / (rows x width). Null, NaN and
    infinities are no values.
    """
    long = long_form(df, columns, keep=[by]).filter(F.col(by).isNotNull())
    long = long.withColumn("value", F.when(F.abs("value") < float("inf"), F.col("value")))
    spans = long.groupBy("feature", by).agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.count("value").alias("rows")
    )
    flat = F.col("lo") == F.col("hi")
    half = F.greatest(F.lit(0.5), F.abs("lo") * 2.0**-32)
    spans = spans.select(
        "feature", by, "rows",
        F.when(flat, F.col("lo") - half).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + half).otherwise(F.col("hi")).alias("hi"),
    ).withColumn("width", (F.col("hi") - F.col("lo")) / F.lit(float(bins)))
    spans = settle(spans)

    guess = F.least(F.floor((F.col("value") - F.col("lo")) / F.col("width")), F.lit(bins - 1))
    edge = F.col("lo") + F.col("guess") * F.col("width")
    above = F.col("lo") + (F.col("guess") + 1) * F.col("width")
    # a value on an edge must land by the edge itself, not by the division's rounding
    exact = (
        F.when(F.col("value") < edge, F.col("guess") - 1)
        .when((F.col("value") >= above) & (F.col("guess") < bins - 1), F.col("guess") + 1)
        .otherwise(F.col("guess"))
    )
    counted = (
        long.filter(F.col("value").isNotNull()).join(spans, ["feature", by])
        .withColumn("guess", guess)
        .groupBy("feature", by, exact.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grid = spans.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return grid.join(counted, ["feature", by, "bin"], "left").select(
        "feature", by, "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"),
        F.when(F.col("bin") == bins - 1, F.col("hi"))
        .otherwise(F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
        F.try_divide(F.coalesce("n", F.lit(0)), F.col("rows") * F.col("width")).alias("density"),
    )


def box_stats(df: DataFrame, value: str, by: str) -> DataFrame:
    """Five-number summary, 1.5 IQR whiskers and outlier count by class; null and NaN are no values."""
    rows = _measured(df, value, by)
    fences = settle(radix_quantiles(rows, [value], {"q1": 0.25, "median": 0.5, "q3": 0.75}, by=[by], settled=True).drop("feature", "n"))
    reach = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    inside = F.col(value).between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        rows.join(fences, by)
        .groupBy(by, "q1", "median", "q3")
        .agg(
            F.min(value).alias("min"),
            F.max(value).alias("max"),
            F.min(F.when(inside, F.col(value))).alias("whisker_low"),
            F.max(F.when(inside, F.col(value))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
        .select(by, "min", "whisker_low", "q1", "median", "q3", "whisker_high", "max", "outliers")
    )


def violin_stats(df: DataFrame, value: str, by: str) -> DataFrame:
    """Count, mean, exact median, min and max by level; null and NaN are no values."""
    rows = _measured(df, value, by)
    medians = radix_quantiles(rows, [value], {"median": 0.5}, by=[by], settled=True)
    rest = rows.groupBy(by).agg(F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"))
    return rest.join(medians, by).select(by, "n", "mean", "median", "min", "max")


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Contingency counts in long form; null keys are left out."""
    return df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(
        F.count(F.lit(1)).alias("n")
    )


def conditional_counts(df: DataFrame, conditions: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """How many rows meet each condition, in one pass."""
    return df.groupBy(*by).agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])


def column_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent non-null value per column, the smallest value on ties.

    Heavy-hitter summaries leave few values to be counted; a column without a heavy value,
    such as a key, is counted in full.
    """
    counts = most_frequent(df, columns)
    return counts.groupBy("feature").agg(mode_of("value", "n", numeric_columns(df)).alias("top")).select(
        "feature", F.col("top.value").alias("mode"), (-F.col("top.minus_n")).alias("n")
    )


def mode_of(value: str, n: str, numeric: Sequence[str]) -> Column:
    """Aggregate: struct of the most frequent value; numbers tie-break as numbers."""
    as_number = F.when(F.col("feature").isin(list(numeric)), F.col(value).try_cast("double"))
    return F.min(
        F.when(
            F.col(value).isNotNull(),
            F.struct((-F.col(n)).alias("minus_n"), as_number.alias("number"), F.col(value).alias("value")),
        )
    )


def union_cuts(parts: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL of separately computed cuts, matched by column name."""
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


def duplicate_rows(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Rows equal to an earlier row on ``keys`` (default: all columns); nulls are equal.

    Whole rows are compared by a typed 256-bit digest, so their columns don't cross the
    shuffle. Zeros of either sign are equal, and NaN equals NaN; timestamps count to the
    microsecond.
    """
    grouped = df.groupBy(*keys) if keys else df.groupBy(row_digest(df).alias("row"))
    counted = grouped.agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def grid_counts(df: DataFrame, x: Column, y: Column, flag: str) -> DataFrame:
    """Two-way binned counts with the flagged share: the data of a scatter chart."""
    return df.groupBy(x.alias("x_bin"), y.alias("y_bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(flag).alias("rate")
    )


