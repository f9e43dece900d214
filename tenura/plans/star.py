"""Star schema: five dimensions and one fact."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura import specs
from tenura.functions.arithmetic import ratio
from tenura.functions.encode import band, decode, yes_no
from tenura.operators.aggregate import distinct_tuples, distinct_values
from tenura.operators.joins import counted, lookup_join
from tenura.operators.ordering import dense_key, number_rows
from tenura.session import settle

# dimension -> (key, {clean column: dimension column}, sort order in dimension columns)
DIMENSIONS = {
    "dim_department": (
        "department_key", {"department": "department_name"}, ["department_name"],
    ),
    "dim_job_role": (
        "job_role_key",
        {"job_role": "job_role_name", "department": "department_name"},
        ["department_name", "job_role_name"],
    ),
    "dim_education_field": (
        "education_field_key", {"education_field": "education_field_name"}, ["education_field_name"],
    ),
    "dim_marital_status": (
        "marital_status_key", {"marital_status": "marital_status_name"}, ["marital_status_name"],
    ),
    "dim_business_travel": (
        "business_travel_key",
        {"business_travel": "business_travel_name", "business_travel_encoded": "travel_frequency_ordinal"},
        ["travel_frequency_ordinal", "business_travel_name"],
    ),
}
# which of a dimension's columns the fact joins on; all of them unless listed
_JOIN_COLUMNS = {"dim_business_travel": ["business_travel"]}


@dataclass(frozen=True)
class Dimensions:
    """The dimension tables, and whether their keys were grouped here and so are unique."""

    tables: Mapping[str, DataFrame]
    unique: bool = False


def _numbered(values: DataFrame, name: str, known_small: bool = False) -> DataFrame:
    key, columns, order = DIMENSIONS[name]
    return number_rows(values, order, key, known_small).select(key, *columns.values())


def dimension(silver: DataFrame, name: str) -> DataFrame:
    """One dimension: distinct values with a surrogate key 1..n."""
    _, columns, _ = DIMENSIONS[name]
    return _numbered(distinct_values(silver, *columns).withColumnsRenamed(columns), name)


def dimensions(silver: DataFrame) -> Dimensions:
    """All five dimensions from one scan of the clean table."""
    sets = {name: list(columns) for name, (_, columns, _) in DIMENSIONS.items()}
    types = {f.name: f.dataType for f in silver.schema.fields}
    tuples, small = counted(distinct_tuples(silver, sets))
    built = {}
    for name, (_, columns, _) in DIMENSIONS.items():
        values = tuples.filter(F.col("set_name") == name).select(
            *[F.col(f"v{i}").cast(types[old]).alias(new) for i, (old, new) in enumerate(columns.items(), 1)]
        )
        built[name] = _numbered(values, name, small)
    return Dimensions(built, unique=True)


def label_columns() -> dict:
    """Labels, bands and derived measures of a clean row."""
    return {
        "attrition_label": yes_no("attrition"),
        "age_band": band("age", specs.AGE_BAND),
        "gender_label": yes_no("gender", "Male", "Female"),
        "overtime_label": yes_no("overtime"),
        "education_label": decode("education", specs.EDUCATION_LABELS),
        "income_quartile": band("monthly_income", specs.INCOME_BAND),
        "tenure_band": band("years_at_company", specs.TENURE_BAND_4),
        "income_per_experience_year": F.round(ratio("monthly_income", "total_working_years"), 2),
        "company_loyalty_ratio": F.round(ratio("years_at_company", "total_working_years"), 4),
        "years_before_current_role": F.col("years_at_company") - F.col("years_in_current_role"),
    }


def labelled(silver: DataFrame) -> DataFrame:
    """Clean rows with labels and bands: the fact without surrogate keys."""
    return silver.withColumns(label_columns())


def with_dimension_keys(silver: DataFrame, dims: Dimensions) -> DataFrame:
    """Clean rows with the five foreign keys (five LEFT joins)."""
    rows = silver
    for name, (key, columns, _) in DIMENSIONS.items():
        on = {old: columns[old] for old in _JOIN_COLUMNS.get(name, columns)}
        lookup = dims.tables[name].select(key, *on.values())
        rows = lookup_join(rows, lookup, on, known_unique=dims.unique)
    return rows


def fact(silver: DataFrame, dims: Dimensions | None = None) -> DataFrame:
    """One row per employee: 47 columns in order.

    The surrogate key numbers rows by department, role, age and income, with the
    employee number as the last sort column so that the numbering is unique. The clean
    rows are written first: numbering and dimensions read them instead of making them anew.
    """
    order = [*specs.FACT_ORDER, specs.KEY]
    rows = settle(silver)
    keyed = dense_key(rows, order, "employee_key", settled=True)
    joined = with_dimension_keys(keyed, dims or dimensions(rows))
    return labelled(joined).select(*specs.FACT_COLUMNS)
