"""The data behind each dashboard visual."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.operators.aggregate import grid_counts, histogram, median_gap, value_counts
from tenura.operators.columns import long_form

# fixed values: the four scales of the satisfaction heatmap
SATISFACTION_SCALES = [
    "environment_satisfaction", "job_satisfaction", "relationship_satisfaction", "work_life_balance",
]


def _rate_by(fact: DataFrame, *columns: str) -> DataFrame:
    return fact.groupBy(*columns).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("attrition").cast("bigint")).alias("left"),
        (F.avg("attrition") * 100).alias("attrition_rate"),
    )


def _rates_long(fact: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Rates by several columns as (dimension, value), one scan."""
    named = fact.select("attrition", *[F.col(c).alias(title) for title, c in columns.items()])
    return _rate_by(
        long_form(named, list(columns), ["attrition"], "string", "dimension"), "dimension", "value"
    )


def kpi_cards(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count(F.lit(1)).alias("total_employees"),
        (F.avg("attrition") * 100).alias("attrition_rate"),
        F.avg("monthly_income").alias("avg_income"),
        F.avg("years_at_company").alias("avg_tenure"),
    )


def by_department_and_age(fact: DataFrame) -> DataFrame:
    return _rates_long(fact, {"Department": "department", "Age Band": "age_band"})


def gender_distribution(fact: DataFrame) -> DataFrame:
    return value_counts(fact, "gender_label")


def overtime_impact(fact: DataFrame) -> DataFrame:
    return _rate_by(fact, "overtime_label")


def satisfaction_heatmap(fact: DataFrame) -> DataFrame:
    """Rate by (scale, level)."""
    return _rate_by(
        long_form(fact, SATISFACTION_SCALES, ["attrition"], "int", "scale", "level"), "scale", "level"
    )


def overtime_multiplier(fact: DataFrame) -> DataFrame:
    """Rate with overtime over rate without."""
    one = fact.agg(
        F.avg(F.when(F.col("overtime") == 1, F.col("attrition"))).alias("rate_overtime"),
        F.avg(F.when(F.col("overtime") == 0, F.col("attrition"))).alias("rate_regular"),
    )
    return one.withColumn(
        "multiplier", F.col("rate_overtime") / F.nullif(F.col("rate_regular"), F.lit(0.0))
    )


def travel_and_marital(fact: DataFrame) -> DataFrame:
    return _rates_long(fact, {"Business Travel": "business_travel", "Marital Status": "marital_status"})


def tenure_curve(fact: DataFrame) -> DataFrame:
    return _rate_by(fact, "years_at_company")


def income_distribution(fact: DataFrame, bins: int = 30) -> DataFrame:
    """Income histogram by status."""
    return histogram(fact, ["monthly_income"], "attrition_label", bins)


def income_gap(fact: DataFrame) -> DataFrame:
    """Median and mean income of stayers and leavers, and the gaps."""
    gap = median_gap(fact, "monthly_income", "attrition_label", "No", "Yes")
    return gap.withColumnsRenamed(
        {"median_high": "median_stayed", "median_low": "median_left",
         "mean_high": "mean_stayed", "mean_low": "mean_left"}
    )


def salary_hike(fact: DataFrame) -> DataFrame:
    return _rate_by(fact, "percent_salary_hike")


def stock_impact(fact: DataFrame) -> DataFrame:
    return _rate_by(fact, "stock_option_level")


def experience_income(fact: DataFrame, years: int = 5, income: int = 1000) -> DataFrame:
    """Experience against income, binned; with the rate in each cell."""
    return grid_counts(
        fact,
        (F.floor(F.col("total_working_years") / years) * years).cast("bigint"),
        (F.floor(F.col("monthly_income") / income) * income).cast("bigint"),
        "attrition",
    )


def probability_income(predictions: DataFrame, step: int = 5, income: int = 1000) -> DataFrame:
    """Probability (in percent bins) against income, binned; with the rate in each cell."""
    return grid_counts(
        predictions,
        (F.floor(F.col("attrition_probability") * 100 / step) * step).cast("bigint"),
        (F.floor(F.col("monthly_income") / income) * income).cast("bigint"),
        "attrition",
    )


def risk_tiers(predictions: DataFrame) -> DataFrame:
    """People and mean probability by department and tier."""
    return predictions.groupBy("department_name", "risk_tier").agg(
        F.count(F.lit(1)).alias("n"), F.avg("attrition_probability").alias("avg_probability")
    )
