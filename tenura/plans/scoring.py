"""Batch scoring, the predictions table and the risk reports over it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura import specs
from tenura.functions.arithmetic import logistic, percent
from tenura.functions.encode import band, one_hot_decode, yes_no
from tenura.operators.ordering import dense_key
from tenura.operators.ranking import confusion_counts
from tenura.operators.topk import top_k
from tenura.plans.training import score, select_best_run


def batch_score(features: DataFrame, runs: DataFrame) -> DataFrame:
    """Score all rows with the best logged model and its own feature list."""
    run = select_best_run(runs).first()
    model = PipelineModel.load(run["model_path"])
    columns = run["features"]
    return score(model, features, columns, keep=features.columns)


def score_linear(features: DataFrame, weights: Mapping[str, float], intercept: float) -> DataFrame:
    """Score with a stored coefficient table: one expression, no model object."""
    total = F.lit(float(intercept))
    for column, weight in weights.items():
        total = total + F.coalesce(F.col(column), F.lit(0)).cast("double") * F.lit(float(weight))
    probability = logistic(total)
    return features.withColumn("probability", probability).withColumn(
        "prediction", F.when(F.col("probability") > 0.5, 1).otherwise(0)
    )


def with_risk(scored: DataFrame) -> DataFrame:
    """Rounded probability, class and risk tier (tiers are cut on the rounded value)."""
    return (
        scored.withColumn("attrition_probability", F.round("probability", 4))
        .withColumn("predicted_attrition", F.col("prediction"))
        .withColumn("risk_tier", band("attrition_probability", specs.RISK_TIER))
    )


def with_labels(scored: DataFrame) -> DataFrame:
    """Readable labels back from the indicator columns."""
    decoded = {
        f"{column}_name": one_hot_decode(specs.ONE_HOT[column], default)
        for column, default in specs.DECODE_DEFAULTS.items()
    }
    return scored.withColumns(
        {
            **decoded,
            "overtime_label": yes_no("overtime"),
            "gender_label": yes_no("gender", "Male", "Female"),
            "attrition_label": yes_no("attrition"),
        }
    )


def predictions(scored: DataFrame) -> DataFrame:
    """The predictions table: 23 columns, keyed 1..n by department, role, age and income.

    ``scored`` has the features, the employee number, probability and prediction.
    """
    table = with_labels(with_risk(scored))
    narrow = table.select(*[c for c in specs.PREDICTION_COLUMNS if c != "employee_key"], specs.KEY)
    keyed = dense_key(narrow, [*specs.PREDICTION_ORDER, specs.KEY], "employee_key")
    return keyed.select(*specs.PREDICTION_COLUMNS)


# --- reports over the predictions table ----------------------------------------------

def score_summary(table: DataFrame) -> DataFrame:
    p = "attrition_probability"
    return table.agg(
        F.count(F.lit(1)).alias("n"),
        F.min(p).alias("min_probability"),
        F.max(p).alias("max_probability"),
        F.avg(p).alias("mean_probability"),
        F.sum(F.col("predicted_attrition").cast("bigint")).alias("predicted_positive"),
    )


def tier_distribution(table: DataFrame) -> DataFrame:
    """Count and percent per tier, High to Low; tiers without rows are kept."""
    counted = table.agg(
        *[F.count_if(F.col("risk_tier") == tier).alias(tier) for tier in specs.TIER_ORDER],
        F.count(F.lit(1)).alias("rows"),
    )
    lines = [
        F.struct(
            F.lit(i).alias("position"), F.lit(tier).alias("risk_tier"), F.col(tier).alias("n"),
            percent(F.col(tier), F.col("rows")).alias("pct"),
        )
        for i, tier in enumerate(specs.TIER_ORDER, 1)
    ]
    return counted.select(F.inline(F.array(*lines)))


def risk_by_department(table: DataFrame) -> DataFrame:
    return (
        table.groupBy("department_name")
        .agg(
            F.avg("attrition_probability").alias("avg_risk"),
            F.count_if(F.col("risk_tier") == "High").alias("high_risk_count"),
            F.count(F.lit(1)).alias("headcount"),
        )
        .orderBy(F.col("avg_risk").desc(), "department_name")
    )


def risk_by_role(table: DataFrame, k: int = 5) -> DataFrame:
    means = table.groupBy("job_role_name").agg(F.avg("attrition_probability").alias("avg_risk"))
    return top_k(means, k, F.col("avg_risk").desc(), F.col("job_role_name"))


def top_risk(table: DataFrame, k: int = 15) -> DataFrame:
    """The k highest probabilities with context and outcome; ties by key."""
    best = top_k(table, k, F.col("attrition_probability").desc(), F.col("employee_key"))
    return best.select(
        "employee_key", "risk_tier", "attrition_probability", "department_name", "job_role_name",
        "age", "monthly_income", yes_no("attrition", "LEFT", "stayed").alias("outcome"),
    )


def score_validation(table: DataFrame) -> DataFrame:
    """Confusion counts with recall and precision, 0 where undefined."""
    counts = confusion_counts(table, "attrition", "predicted_attrition")
    tp = F.col("tp").cast("double")
    return counts.withColumns(
        {
            "actual_positive": F.col("tp") + F.col("fn"),
            "predicted_positive": F.col("tp") + F.col("fp"),
            "recall": F.when(F.col("tp") + F.col("fn") > 0, tp / (F.col("tp") + F.col("fn"))).otherwise(F.lit(0.0)),
            "precision": F.when(F.col("tp") + F.col("fp") > 0, tp / (F.col("tp") + F.col("fp"))).otherwise(F.lit(0.0)),
        }
    )


def tier_vs_actual(table: DataFrame) -> DataFrame:
    """Per tier: rows, leavers, mean probability and the actual rate."""
    return table.groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(F.col("attrition").cast("bigint")).alias("actual_left"),
        F.avg("attrition_probability").alias("avg_probability"),
        F.avg("attrition").alias("actual_rate"),
    )
