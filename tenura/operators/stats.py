"""Association statistics, computed where the data is.

Rows are reduced to per-feature sums or value counts by Spark; p-values are then
taken from the finished one-row-per-feature statistics.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura.functions.products import PAIR_SUMS, pair_sums
from tenura.functions.pvalues import EXACT_OTHERS, EXACT_ROWS, chi2_p, normal_p, rank_sum_p, student_p
from tenura.operators.columns import long_form, present, without_nan
from tenura.operators.ordering import running_totals
from tenura.session import settle


def correlation(x: Column, y: Column) -> Column:
    """Pearson's r over rows with both values; null where one of them doesn't vary or is infinite."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    r = without_nan(F.try_divide(F.covar_pop(x, y), F.nullif(spread, F.lit(0.0))))
    # rounding may step over the ends
    return F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))


def point_biserial(df: DataFrame, columns: Sequence[str], flag: str, alpha: float) -> DataFrame:
    """Correlation of each numeric column with a 0/1 flag; nulls and NaN are dropped pairwise.

    A column that doesn't vary, or has fewer than three pairs, gets a null p-value and
    is not significant. ``position`` gives the order of the report: by |r|, largest
    first, null last.
    """
    x, y = without_nan(F.col("value")), without_nan(F.col("_y"))
    long = long_form(df.withColumn("_y", F.col(flag).cast("double")), columns, keep=["_y"])
    one = long.groupBy("feature").agg(
        correlation(x, y).alias("correlation"),
        F.count_if(x.isNotNull() & y.isNotNull()).alias("n"),
    )
    r, dof = F.col("correlation"), F.col("n") - 2
    t = r * F.sqrt(F.try_divide(dof.cast("double"), F.nullif(1 - r * r, F.lit(0.0))))
    t = F.when(dof < 1, F.lit(None)).when(F.abs(r) >= 1, F.lit(float("inf"))).otherwise(t)
    told = (
        one.withColumn("abs_corr", F.abs("correlation"))
        .withColumn("p_value", F.nanvl(student_p(t, dof), F.lit(None).cast("double")))
        .withColumn("significant", F.coalesce(F.col("p_value") < alpha, F.lit(False)))
    )
    return told.withColumn("position", report_place(F.col("abs_corr").desc_nulls_last(), "feature"))


def report_place(*order: str | Column) -> Column:
    """The place of each row in a report of one row per column or pair."""
    return F.row_number().over(Window.orderBy(*order))


def pearson_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All pairwise correlations in long form (both triangles and the diagonal).

    One algorithm with and without holes: nulls and NaN are dropped pair by pair. Each
    task sums cross products of its batches, so columns x columns numbers leave it. A
    column that doesn't vary has null correlations, with itself, too; so has a pair of
    columns with an infinity in a row that has both.
    """
    columns = list(columns)
    numbers = df.select(*[without_nan(F.col(c)).alias(c) for c in columns])
    finite = lambda c: F.when(F.abs(c) < float("inf"), F.col(c))
    means = numbers.agg(*[F.avg(finite(c)).alias(c) for c in columns]).first()
    shifts = [0.0 if m is None else float(m) for m in means]
    sums = numbers.mapInPandas(pair_sums(len(columns), shifts), PAIR_SUMS)
    names = ("n", "x", "y", "xx", "yy", "xy", "endless")
    whole = sums.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in names])
    n, x, y, xx, yy, xy, endless = (F.col(c) for c in names)
    dx, dy = n * xx - x * x, n * yy - y * y
    # what rounding leaves of a column that doesn't vary
    still = (dx <= 1e-14 * n * xx) | (dy <= 1e-14 * n * yy) | (endless > 0)
    r = F.when(~still, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(n * xy - x * y, F.sqrt(dx) * F.sqrt(dy)))))
    upper = whole.select("i", "j", F.when((F.col("i") == F.col("j")) & ~still, F.lit(1.0)).otherwise(r).alias("r"))
    both = upper.unionByName(upper.filter("i < j").select(F.col("j").alias("i"), F.col("i").alias("j"), "r"))
    name = F.array(*[F.lit(c) for c in columns])
    return both.select(F.element_at(name, F.col("i") + 1).alias("a"), F.element_at(name, F.col("j") + 1).alias("b"), "r")


def high_correlations(df: DataFrame, columns: Sequence[str], above: float, drop_above: float) -> DataFrame:
    """Column pairs, in the given column order, with |r| above a bound, and what to do."""
    place = F.create_map(*[F.lit(x) for i, c in enumerate(columns) for x in (c, i)])
    matrix = pearson_matrix(df, columns)
    return (
        matrix.filter((place[F.col("a")] < place[F.col("b")]) & (F.abs("r") > above))
        .withColumn("action", F.when(F.abs("r") > drop_above, "drop one").otherwise("monitor"))
        .withColumn("position", report_place(F.abs("r").desc(), "a", "b"))
    )


def chi_squared(df: DataFrame, columns: Sequence[str], label: str, alpha: float) -> DataFrame:
    """Test of independence per categorical column, with Cramer's V.

    Yates' correction applies when there is one degree of freedom. All columns
    share one scan; afterwards only (feature, level, class) counts are handled.
    """
    long = long_form(df, columns, keep=[label], dtype="string", value="level")
    cells = settle(
        long.filter(F.col("level").isNotNull() & F.col(label).isNotNull())
        .groupBy("feature", "level", label)
        .agg(F.count(F.lit(1)).alias("o"))
    )
    rows = cells.groupBy("feature", "level").agg(F.sum("o").alias("r"))
    cols = cells.groupBy("feature", label).agg(F.sum("o").alias("c"))
    joined = cells.join(rows, ["feature", "level"]).join(cols, ["feature", label])
    # sum over present cells of o^2 / (r c); absent cells add nothing
    fit = joined.groupBy("feature").agg(
        F.sum("o").alias("n"),
        F.sum(F.col("o").cast("double") * F.col("o") / (F.col("r").cast("double") * F.col("c"))).alias("fit"),
    ).join(
        rows.groupBy("feature").agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum(1 / F.col("r").cast("double")).alias("inv_r")
        ),
        "feature",
    ).join(
        cols.groupBy("feature").agg(
            F.count(F.lit(1)).alias("n_cols"), F.sum(1 / F.col("c").cast("double")).alias("inv_c")
        ),
        "feature",
    )
    # in a 2 x 2 table every cell is off by the same amount
    gap = joined.join(fit.select("feature", "n"), "feature").groupBy("feature").agg(
        F.max(F.abs(F.col("o") - F.col("r").cast("double") * F.col("c") / F.col("n"))).alias("gap")
    )
    n, dof = F.col("n"), (F.col("n_rows") - 1) * (F.col("n_cols") - 1)
    shrunk = F.greatest(F.col("gap") - 0.5, F.lit(0.0))
    plain = F.greatest(n * (F.col("fit") - 1), F.lit(0.0))
    corrected = shrunk * shrunk * n * F.col("inv_r") * F.col("inv_c")
    side = F.least(F.col("n_rows"), F.col("n_cols")) - 1
    return (
        fit.join(gap, "feature")
        .select("feature", "n", dof.cast("bigint").alias("dof"), side.alias("side"),
                F.when(dof == 1, corrected).when(dof == 0, F.lit(0.0)).otherwise(plain).alias("chi2"))
        .withColumn("p_value", F.when(F.col("dof") == 0, F.lit(1.0)).otherwise(chi2_p("chi2", "dof")))
        .withColumn("cramers_v",
                    F.when(F.col("side") > 0, F.sqrt(F.col("chi2") / (F.col("n") * F.col("side")))).otherwise(F.lit(0.0)))
        .withColumn("significant", F.coalesce(F.col("p_value") < alpha, F.lit(False)))
        .drop("side")
        .withColumn("position", report_place(F.col("cramers_v").desc_nulls_last(), "feature"))
    )


def class_counts_by_value(df: DataFrame, value: str, flag: str) -> DataFrame:
    """Distinct values with the counts of flagged (pos) and other (neg) rows."""
    return (
        df.filter(present(df, value).isNotNull() & F.col(flag).isNotNull())
        .groupBy(value)
        .agg(F.sum(F.col(flag).cast("bigint")).alias("pos"), F.sum(1 - F.col(flag).cast("bigint")).alias("neg"))
    )


def mann_whitney(df: DataFrame, value: str, flag: str, known_small: bool = False) -> DataFrame:
    """Two-sided rank-sum test of a measure between flagged and other rows.

    U is that of the flagged rows; ties count half. Null and NaN are no values. Where a
    sample has eight rows or fewer and no two values are equal, the p-value is exact, from the
    number of orders that give each U; else it is the normal approximation with tie and
    continuity corrections, as it is where the other sample has more than a million rows.
    """
    counts = class_counts_by_value(df, value, flag)
    ranked = running_totals(counts, ["pos", "neg"], [value], known_small=known_small)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    ties = pos + neg
    one = ranked.agg(
        F.sum(pos * (F.col("neg_before") + neg / 2)).alias("u"),
        F.sum("pos").alias("n_pos"),
        F.sum("neg").alias("n_neg"),
        F.sum(ties * ties * ties - ties).alias("tie"),
    )
    n1, n2 = F.col("n_pos").cast("double"), F.col("n_neg").cast("double")
    n = n1 + n2
    sigma = F.sqrt(n1 * n2 / 12 * ((n + 1) - F.col("tie") / (n * (n - 1))))
    exact = (F.least(n1, n2) <= EXACT_ROWS) & (F.greatest(n1, n2) <= EXACT_OTHERS) & (F.col("tie") == 0)
    z = (F.greatest(F.col("u"), n1 * n2 - F.col("u")) - n1 * n2 / 2 - 0.5) / F.nullif(sigma, F.lit(0.0))
    return (
        one.filter((F.col("n_pos") > 0) & (F.col("n_neg") > 0))
        .withColumn("z", z)
        .withColumn("p_value", F.when(exact, rank_sum_p("u", "n_pos", "n_neg")).otherwise(normal_p(F.greatest(F.col("z"), F.lit(0.0)))))
        .withColumn("auc", F.col("u") / (n1 * n2))
        .drop("tie")
    )


def weak_features(correlations: DataFrame, below: float, fallback: int = 5) -> DataFrame:
    """Features with |r| below a bound, or the weakest few when there are none."""
    weak = F.coalesce(F.col("abs_corr") < below, F.lit(False))
    # one row per feature, computed once
    table = settle(correlations)
    if table.filter(weak).head(1):
        return table.filter(weak)
    return table.filter("abs_corr is not null").orderBy("abs_corr", "feature").limit(fallback)


def strong_features(correlations: DataFrame, tests: DataFrame, above: float, alpha: float) -> DataFrame:
    """Numeric features by |r| and categorical ones by p-value."""
    numeric = correlations.filter(F.col("abs_corr") > above).select(
        "feature", F.lit("numeric").alias("kind")
    )
    categorical = tests.filter(F.col("p_value") < alpha).select(
        "feature", F.lit("categorical").alias("kind")
    )
    return numeric.unionByName(categorical)
