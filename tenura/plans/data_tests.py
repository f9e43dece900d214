"""The data tests of every layer (68), and the row-count checkpoints."""

from __future__ import annotations

from tenura.operators.quality import (
    Check, accepted, min_rows, not_null, relationship, same_rows, unique,
)

# table names used below and by the model registry
RAW = "bronze.people"
CLEAN = "silver.people_clean"
FEATURES = "gold.ml_features"
ANALYTICS = "gold.attrition_analytics"
FACT = "gold.fact_attrition"
PREDICTIONS = "gold.attrition_predictions"
DIM = "gold.{}"

# --- fixed values: which column must pass which test --------------------------
RAW_CHECKS: list[Check] = [
    *not_null(RAW, "Age", "Attrition", "BusinessTravel", "Department", "EducationField",
              "EmployeeNumber", "JobRole"),
    *unique(RAW, "EmployeeNumber"),
    accepted(RAW, "Attrition", "Yes", "No"),
    accepted(RAW, "BusinessTravel", "Non-Travel", "Travel_Rarely", "Travel_Frequently"),
    accepted(RAW, "Department", "Sales", "Research & Development", "Human Resources"),
    accepted(RAW, "Gender", "Male", "Female"),
    accepted(RAW, "MaritalStatus", "Single", "Married", "Divorced"),
    accepted(RAW, "OverTime", "Yes", "No"),
]
CLEAN_CHECKS: list[Check] = [
    *not_null(CLEAN, "age", "attrition", "overtime", "gender", "monthly_income", "department",
              "job_role", "marital_status", "business_travel", "education_field"),
    accepted(CLEAN, "attrition", 0, 1),
    accepted(CLEAN, "overtime", 0, 1),
    accepted(CLEAN, "gender", 0, 1),
]
FEATURE_CHECKS: list[Check] = [
    *not_null(FEATURES, "attrition", "income_per_year", "promo_stagnation"),
    accepted(FEATURES, "attrition", 0, 1),
]
ANALYTICS_CHECKS: list[Check] = not_null(
    ANALYTICS, "dimension_name", "dimension_value", "total_employees", "attrition_count", "attrition_rate"
)
_DIMENSION_COLUMNS = {
    "dim_department": ("department_key", ["department_name"]),
    "dim_job_role": ("job_role_key", ["job_role_name", "department_name"]),
    "dim_education_field": ("education_field_key", ["education_field_name"]),
    "dim_marital_status": ("marital_status_key", ["marital_status_name"]),
    "dim_business_travel": ("business_travel_key", ["business_travel_name"]),
}
DIMENSION_CHECKS: list[Check] = [
    check
    for name, (key, columns) in _DIMENSION_COLUMNS.items()
    for check in (*unique(DIM.format(name), key), *not_null(DIM.format(name), key, *columns))
]
FACT_CHECKS: list[Check] = [
    *unique(FACT, "employee_key"),
    *not_null(FACT, "employee_key", *[key for key, _ in _DIMENSION_COLUMNS.values()],
              "attrition", "monthly_income", "age"),
    *[relationship(FACT, key, DIM.format(name), key) for name, (key, _) in _DIMENSION_COLUMNS.items()],
    accepted(FACT, "attrition", 0, 1),
]
DECLARED: list[Check] = [
    *RAW_CHECKS, *CLEAN_CHECKS, *FEATURE_CHECKS, *ANALYTICS_CHECKS, *DIMENSION_CHECKS, *FACT_CHECKS,
]


def checkpoints(rows: int, tables: tuple[str, ...] = (RAW, CLEAN, FEATURES, FACT)) -> list[Check]:
    """Row-count checkpoints: at least ``rows`` each, and no row lost after the raw table."""
    return [
        *[min_rows(t, rows) for t in tables],
        *[same_rows(t, RAW) for t in tables if t != RAW],
    ]
