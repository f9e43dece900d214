"""Long-form retention rates by fourteen dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura import specs
from tenura.functions.encode import band, decode, yes_no
from tenura.operators.aggregate import cut, cuts, metric_set, union_cuts


def dimension_columns() -> dict[str, Column]:
    """Dimension name -> the value a clean row has in it."""
    name, value = specs.OVERALL
    return {
        name: F.lit(value),
        "Department": F.col("department"),
        "Job Role": F.col("job_role"),
        "OverTime": yes_no("overtime"),
        "Marital Status": F.col("marital_status"),
        "Gender": yes_no("gender", "Male", "Female"),
        "Job Level": F.col("job_level"),
        "Age Band": band("age", specs.AGE_BAND),
        "Tenure Band": band("years_at_company", specs.TENURE_BAND_5),
        "Income Quartile": band("monthly_income", specs.INCOME_BAND_NAMED),
        "Business Travel": F.col("business_travel"),
        "Education Level": decode("education", specs.EDUCATION_LABELS),
        "Stock Option Level": F.col("stock_option_level"),
        "Distance From Home": band("distance_from_home", specs.DISTANCE_BAND),
    }


def metrics() -> list[Column]:
    return metric_set("attrition", specs.METRIC_AVERAGES)


def one_cut(silver: DataFrame, name: str) -> DataFrame:
    """The cut by a single dimension."""
    return cut(silver, name, dimension_columns()[name], metrics())


def attrition_analytics(silver: DataFrame) -> DataFrame:
    """All cuts from one scan."""
    measures = ["attrition", *specs.METRIC_AVERAGES.values()]
    return cuts(silver, dimension_columns(), measures, metrics())


def attrition_analytics_by_union(silver: DataFrame) -> DataFrame:
    """The same table as fourteen aggregates glued together: one scan per cut."""
    return union_cuts([one_cut(silver, name) for name in dimension_columns()])
