"""Classifier scores: confusion counts, curves and threshold-free metrics.

Scores are first folded to (score, positives, negatives); curves and areas then
come from running totals over distinct scores, so they are exact at any size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.operators.columns import present
from tenura.operators.ordering import running_totals
from tenura.session import settle


def score_counts(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """(score, pos, neg) per group: combined before the shuffle."""
    flag = F.col(label).cast("bigint")
    rows = df.filter(present(df, score).isNotNull() & F.col(label).isNotNull())
    return rows.groupBy(*by, score).agg(F.sum(flag).alias("pos"), F.sum(1 - flag).alias("neg"))


def _thresholds(counts: DataFrame, score: str, by: Sequence[str], known_small: bool = False) -> DataFrame:
    ranked = running_totals(
        counts.withColumn("_falling", -F.col(score)), ["pos", "neg"], ["_falling"], within=by, known_small=known_small, ahead=True
    )
    return ranked.select(
        *by,
        F.col(score).alias("threshold"),
        "pos", "neg",
        (F.col("pos_before") + F.col("pos")).alias("tp"),
        (F.col("neg_before") + F.col("neg")).alias("fp"),
        F.col("pos_total").alias("n_pos"),
        F.col("neg_total").alias("n_neg"),
        "pos_next", "neg_next",
    )


def threshold_table(df: DataFrame, score: str, label: str, by: Sequence[str] = (),
                    known_small: bool = False) -> DataFrame:
    """Per distinct score, highest first: rows at and above it, by true class."""
    return _thresholds(score_counts(df, score, label, by), score, by, known_small)


def _share(part: Column, whole: Column) -> Column:
    """part / whole, 0 when there is nothing to divide by."""
    return F.when(whole != 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


def _corner() -> Column:
    """Whether the curve turns at a point: its step and the next have different slopes, in whole numbers.

    The first and the last threshold count as corners.
    """
    first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
    wide = "decimal(38,0)"  # products of two counts may exceed a long
    left = F.col("pos").cast(wide) * F.col("neg_next").cast(wide)
    right = F.col("pos_next").cast(wide) * F.col("neg").cast(wide)
    return first | F.col("pos_next").isNull() | (left != right)


def roc_curve(df: DataFrame, score: str, label: str, by: Sequence[str] = (), drop_collinear: bool = False) -> DataFrame:
    """False and true positive rate per distinct threshold, from (0, 0) on.

    The start point has the threshold infinity: nobody is said to be positive.
    ``drop_collinear`` leaves out points that lie in line with both neighbours, which change
    neither the drawing nor its area.
    """
    table = threshold_table(df, score, label, by)
    table = settle(table.filter(_corner()) if drop_collinear else table)
    start = table.select(*by).distinct() if by else table.select(F.lit(1).alias("_")).limit(1)
    zero = F.lit(0.0)
    return table.select(
        *by, F.col("threshold").cast("double").alias("threshold"),
        _share(F.col("fp"), F.col("n_neg")).alias("fpr"),
        _share(F.col("tp"), F.col("n_pos")).alias("tpr"),
    ).unionByName(start.select(*by, F.lit(float("inf")).alias("threshold"), zero.alias("fpr"), zero.alias("tpr")))


def pr_curve(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall per distinct threshold, with the base rate, down to (recall 0, precision 1).

    The end point has the threshold infinity.
    """
    table = threshold_table(df, score, label, by)
    base = _share(F.col("n_pos"), F.col("n_pos") + F.col("n_neg")).alias("base_rate")
    end = table.select(*by, base).distinct().select(
        *by, F.lit(float("inf")).alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"), "base_rate"
    )
    return table.select(
        *by, F.col("threshold").cast("double").alias("threshold"),
        _share(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _share(F.col("tp"), F.col("n_pos")).alias("recall"),
        base,
    ).unionByName(end)


def _areas(table: DataFrame, by: Sequence[str]) -> DataFrame:
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    # a positive beats every negative scored lower, and half of its own ties
    beaten = pos * (F.col("n_neg") - F.col("fp") + neg / 2)
    pairs = F.max("n_pos").cast("double") * F.max("n_neg").cast("double")
    precision = F.col("tp").cast("double") / (F.col("tp") + F.col("fp"))
    return table.groupBy(*by).agg(
        (F.sum(beaten) / F.nullif(pairs, F.lit(0.0))).alias("auc_roc"),
        (F.sum(pos * precision) / F.nullif(F.max("n_pos"), F.lit(0))).alias("avg_precision"),
    )


def ranking_metrics(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve and average precision."""
    return _areas(threshold_table(df, score, label, by), by)


def confusion_counts(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, tn in one pass."""
    yes, said = F.col(label) == 1, F.col(prediction) == 1
    no, unsaid = F.col(label) == 0, F.col(prediction) == 0
    return df.groupBy(*by).agg(
        F.count_if(yes & said).alias("tp"),
        F.count_if(no & said).alias("fp"),
        F.count_if(yes & unsaid).alias("fn"),
        F.count_if(no & unsaid).alias("tn"),
    )


def rates_from_confusion(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class; 0 where undefined."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select(
        *by,
        _share(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _share(tp, tp + fp).alias("precision"),
        _share(tp, tp + fn).alias("recall"),
        _share(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def binary_metrics(df: DataFrame, score: str, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """The six headline metrics, one row per group; the rows are scored and read once."""
    folded = settle(score_counts(df, score, label, [*by, prediction]))
    said, unsaid = F.col(prediction) == 1, F.col(prediction) == 0

    def rows(which: Column, side: str) -> Column:
        return F.coalesce(F.sum(F.when(which, F.col(side))), F.lit(0))

    counts = folded.groupBy(*by).agg(
        rows(said, "pos").alias("tp"), rows(said, "neg").alias("fp"),
        rows(unsaid, "pos").alias("fn"), rows(unsaid, "neg").alias("tn"),
    )
    cut_metrics = rates_from_confusion(counts, by)
    per_score = folded.groupBy(*by, score).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    areas = _areas(_thresholds(per_score, score, by), by)
    if by:
        return cut_metrics.join(areas, list(by))
    return cut_metrics.select(
        "*", areas.select("auc_roc").scalar().alias("auc_roc"),
        areas.select("avg_precision").scalar().alias("avg_precision"),
    )


def confusion_matrix(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Four rows (actual, predicted, n) per group; cells without rows are kept as zero."""
    counts = confusion_counts(df, label, prediction, by)
    places = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}
    cells = [
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("n"))
        for c, (a, p) in places.items()
    ]
    return counts.select(*by, F.inline(F.array(*cells)))


def classification_report(df: DataFrame, label: str, prediction: str,
                          names: tuple[str, str] = ("Stayed", "Left"), by: Sequence[str] = ()) -> DataFrame:
    """Per group and class precision, recall, F1 and support; accuracy, macro and weighted means."""
    counts = confusion_counts(df, label, prediction, by)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def line(name: str, hit: Column, wrong: Column, missed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("label"),
            _share(hit, hit + wrong).alias("precision"),
            _share(hit, hit + missed).alias("recall"),
            _share(2 * hit, 2 * hit + wrong + missed).alias("f1"),
            (hit + missed).alias("support"),
        )

    both = counts.select(
        "*", line(names[0], tn, fn, fp).alias("zero"), line(names[1], tp, fp, fn).alias("one")
    )
    total = tp + fp + fn + tn
    parts = ("precision", "recall", "f1")
    accuracy = F.struct(
        F.lit("accuracy").alias("label"),
        *[_share(tp + tn, total).alias(p) for p in parts], total.alias("support"),
    )
    macro = F.struct(
        F.lit("macro avg").alias("label"),
        *[((F.col(f"zero.{p}") + F.col(f"one.{p}")) / 2).alias(p) for p in parts],
        total.alias("support"),
    )
    weighted = F.struct(
        F.lit("weighted avg").alias("label"),
        *[
            _share(F.col(f"zero.{p}") * F.col("zero.support") + F.col(f"one.{p}") * F.col("one.support"), total).alias(p)
            for p in parts
        ],
        total.alias("support"),
    )
    return both.select(*by, F.inline(F.array("zero", "one", accuracy, macro, weighted)))
