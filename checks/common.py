"""Shared inputs of the registered queries and the shared SQL prelude of their twins.

The prelude states every model as plain grouped, joined and windowed SQL over the
same parquet tables, without the library's one-pass and block-wise forms.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura import specs
from tenura.operators.columns import with_flag
from tenura.plans import features, scoring, silver, star
from tenura.session import scratch_path, tune
from tenura.sources.people import people
from tenura.sources.tables import Lake

Query = Callable[[SparkSession, str], DataFrame]

# --- Spark side -----------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tune(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use all cores on an input of few files; an input of many is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return people(spread(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey"))


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_flag(raw(spark, sf_dir), "Attrition_Flag", "Attrition", "Yes")


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.clean(raw(spark, sf_dir))


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.ml_features(clean(spark, sf_dir), keep=(specs.KEY,))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.labelled(clean(spark, sf_dir))


def scored(spark: SparkSession, sf_dir: str, card: str = "Full Card") -> DataFrame:
    weights, intercept = CARDS[card]
    return scoring.score_linear(feature_rows(spark, sf_dir), weights, intercept)


def risk_rows(spark: SparkSession, sf_dir: str, card: str = "Full Card") -> DataFrame:
    """Scored people with labels and tiers, without the surrogate key."""
    return scoring.with_labels(scoring.with_risk(scored(spark, sf_dir, card)))


def all_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three cards' rounded scores in long form."""
    rows = feature_rows(spark, sf_dir)
    for i, (weights, intercept) in enumerate(CARDS.values()):
        one = scoring.score_linear(rows, weights, intercept)
        rows = one.withColumn(f"_p{i}", F.round("probability", 4)).withColumn(f"_y{i}", F.col("prediction"))
        rows = rows.drop("probability", "prediction")
    cells = [x for i, name in enumerate(CARDS) for x in (F.lit(name), F.col(f"_p{i}"), F.col(f"_y{i}"))]
    return rows.select(specs.KEY, "attrition", F.stack(F.lit(len(CARDS)), *cells).alias("model", "score", "prediction"))


def new_lake(spark: SparkSession) -> Lake:
    """A lake of its own in the shared folder."""
    tune(spark)
    path = scratch_path(spark, "lake")
    return Lake(spark, root=path, prefix=f"t{path[-12:]}_")


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Round measures whose last digits depend on the order of summation."""
    return df.withColumns({c: F.round(c, places) for c in columns})


def over(build: Callable[[DataFrame], DataFrame], source: Callable[[SparkSession, str], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(source(spark, sf_dir))


# fixed score cards: name -> (weights, intercept)
CARDS: dict[str, tuple[dict[str, float], float]] = {
    "Full Card": (
        {"overtime": 1.2, "is_entry_level": 0.7, "no_stock_options": 0.6, "marital_single": 0.5,
         "income_per_age": -0.002},
        -2.3,
    ),
    "Overtime Card": ({"overtime": 1.0, "distance_from_home": 0.01}, -2.0),
    "Income Card": ({"monthly_income": -0.0001, "job_level": -0.1}, -1.0),
}

NUMERIC = [
    part.split()[0] for part in specs.RAW_SCHEMA.split(",")
    if part.split()[1] != "STRING" and part.split()[0] not in specs.NUMERIC_EXCLUDED
]
CATEGORICAL = [
    part.split()[0] for part in specs.RAW_SCHEMA.split(",")
    if part.split()[1] == "STRING" and part.split()[0] not in specs.CATEGORICAL_EXCLUDED
]

# --- SQL side ---------------------------------------------------------------------

PEOPLE = """
h AS (
  SELECT o_orderkey AS k,
    (o_orderkey*o_orderkey*7919 + o_orderkey*104729 + 13) % 1000003 AS h1,
    (o_orderkey*o_orderkey*6151 + o_orderkey*15487  + 29) % 1000033 AS h2,
    (o_orderkey*o_orderkey*4421 + o_orderkey*32452  + 53) % 1000037 AS h3,
    (o_orderkey*o_orderkey*9901 + o_orderkey*49979  + 71) % 1000039 AS h4,
    (o_orderkey*o_orderkey*3571 + o_orderkey*86028  + 97) % 1000081 AS h5
  FROM orders),
a AS (
  SELECT k, h1, h2, h3, h4, h5,
    CASE h1 % 9 WHEN 0 THEN 'Sales Executive' WHEN 1 THEN 'Research Scientist'
      WHEN 2 THEN 'Laboratory Technician' WHEN 3 THEN 'Manufacturing Director'
      WHEN 4 THEN 'Healthcare Representative' WHEN 5 THEN 'Manager'
      WHEN 6 THEN 'Sales Representative' WHEN 7 THEN 'Research Director'
      ELSE 'Human Resources' END AS JobRole,
    CASE WHEN h1 % 9 IN (0, 6) THEN 'Sales' WHEN h1 % 9 = 8 THEN 'Human Resources'
      WHEN h1 % 9 = 5 AND h2 % 3 = 0 THEN 'Sales'
      WHEN h1 % 9 = 5 AND h2 % 3 = 1 THEN 'Human Resources'
      ELSE 'Research & Development' END AS Department,
    CAST(1 + h2 % 5 AS INT) AS JobLevel,
    CASE WHEN h3 % 100 < 28 THEN 'Yes' ELSE 'No' END AS OverTime,
    CASE h4 % 3 WHEN 0 THEN 'Single' WHEN 1 THEN 'Married' ELSE 'Divorced' END AS MaritalStatus,
    CASE WHEN h5 % 10 < 4 THEN 0 ELSE CAST(1 + h5 % 3 AS INT) END AS StockOptionLevel,
    CAST(h4 % 41 AS INT) AS TotalWorkingYears
  FROM h),
b AS (SELECT *, CAST(h5 % (TotalWorkingYears + 1) AS INT) AS YearsAtCompany FROM a),
people AS (
SELECT
  CAST(LEAST(60, 18 + TotalWorkingYears + h2 % 8) AS INT) AS Age,
  CASE WHEN (h1 + h2 + h3 + h4 + h5) % 100 <
      6 + CASE WHEN OverTime = 'Yes' THEN 15 ELSE 0 END
        + CASE WHEN JobLevel = 1 THEN 8 ELSE 0 END
        + CASE WHEN StockOptionLevel = 0 THEN 6 ELSE 0 END
        + CASE WHEN MaritalStatus = 'Single' THEN 5 ELSE 0 END
    THEN 'Yes' ELSE 'No' END AS Attrition,
  CASE WHEN h2 % 10 < 1 THEN 'Non-Travel' WHEN h2 % 10 < 8 THEN 'Travel_Rarely'
    ELSE 'Travel_Frequently' END AS BusinessTravel,
  CAST(100 + h1 % 1400 AS INT) AS DailyRate, Department,
  CAST(1 + h3 % 29 AS INT) AS DistanceFromHome,
  CAST(1 + h4 % 5 AS INT) AS Education,
  CASE h5 % 6 WHEN 0 THEN 'Life Sciences' WHEN 1 THEN 'Medical' WHEN 2 THEN 'Marketing'
    WHEN 3 THEN 'Technical Degree' WHEN 4 THEN 'Other' ELSE 'Human Resources' END AS EducationField,
  CAST(1 AS INT) AS EmployeeCount, k AS EmployeeNumber,
  CAST(1 + h1 % 4 AS INT) AS EnvironmentSatisfaction,
  CASE WHEN h2 % 5 < 3 THEN 'Male' ELSE 'Female' END AS Gender,
  CAST(30 + h3 % 71 AS INT) AS HourlyRate,
  CAST(1 + h4 % 4 AS INT) AS JobInvolvement, JobLevel, JobRole,
  CAST(1 + h5 % 4 AS INT) AS JobSatisfaction, MaritalStatus,
  CAST(1009 + 1500 * (JobLevel - 1) + h3 % 4000 AS INT) AS MonthlyIncome,
  CAST(2094 + h1 % 24906 AS INT) AS MonthlyRate,
  CAST(h2 % 10 AS INT) AS NumCompaniesWorked, 'Y' AS Over18, OverTime,
  CAST(11 + h4 % 15 AS INT) AS PercentSalaryHike,
  CAST(3 + CASE WHEN h4 % 15 > 8 THEN 1 ELSE 0 END AS INT) AS PerformanceRating,
  CAST(1 + (h1 + h3) % 4 AS INT) AS RelationshipSatisfaction,
  CAST(80 AS INT) AS StandardHours, StockOptionLevel, TotalWorkingYears,
  CAST(h1 % 7 AS INT) AS TrainingTimesLastYear,
  CAST(1 + (h2 + h4) % 4 AS INT) AS WorkLifeBalance, YearsAtCompany,
  CAST(h1 % (YearsAtCompany + 1) AS INT) AS YearsInCurrentRole,
  CAST(h2 % (YearsAtCompany + 1) AS INT) AS YearsSinceLastPromotion,
  CAST(h3 % (YearsAtCompany + 1) AS INT) AS YearsWithCurrManager
FROM b)"""


def literal(value: object) -> str:
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else repr(value)


def sql_is(column: str, value: object) -> str:
    return f"CASE WHEN {column} = {literal(value)} THEN 1 ELSE 0 END"


def sql_band(column: str, spec) -> str:
    sign = "<" if spec.closed == "left" else "<="
    tests = " ".join(f"WHEN {column} {sign} {cut} THEN {literal(label)}" for cut, label in zip(spec.cuts, spec.labels))
    return f"CASE {tests} ELSE {literal(spec.labels[-1])} END"


def sql_decode(column: str, labels: dict, default: str | None = None) -> str:
    tests = " ".join(f"WHEN {literal(k)} THEN {literal(v)}" for k, v in labels.items())
    end = "" if default is None else f" ELSE {literal(default)}"
    return f"CASE {column} {tests}{end} END"


def sql_ratio(numerator: str, denominator: str, plus: int = 0) -> str:
    below = f"{denominator} + {plus}" if plus else denominator
    return f"CAST({numerator} AS DOUBLE) / NULLIF({below}, 0)"


def sql_round_ratio(numerator: str, denominator: str, places: int) -> str:
    """Half-up rounding of an integer ratio, as Spark rounds it.

    Rounding the double quotient by scaling misplaces decimal ties (258.525), so
    the tie is decided in whole numbers.
    """
    n, d, scale = f"CAST({numerator} AS BIGINT)", f"NULLIF({denominator}, 0)", 10 ** places
    return f"CAST(({n} * {2 * scale} + {d}) // (2 * {d}) AS DOUBLE) / {scale}"


def _named(pairs: dict[str, str]) -> str:
    return ",\n  ".join(f"{expression} AS {name}" for name, expression in pairs.items())


_silver = {
    **{new: old for old, new in specs.RENAMES.items()},
    **{name: sql_is(column, yes) for name, (column, yes) in specs.FLAGS.items()},
    "business_travel_encoded": sql_decode("BusinessTravel", specs.TRAVEL_ORDER),
}
SILVER = "silver AS (SELECT " + _named(
    {name: _silver[name] for name in specs.CLEAN_COLUMNS} | {specs.KEY: "EmployeeNumber"}
) + " FROM people)"

RATIOS = {name: sql_ratio(*parts) for name, parts in specs.RATIOS.items()}
COMPOSITES = {name: f"({' + '.join(cols)}) / {len(cols)}.0" for name, cols in specs.COMPOSITES.items()}
FLAGS = {
    name: f"CASE WHEN {column} {sign} {bound} THEN 1 ELSE 0 END"
    for name, (column, sign, bound) in specs.THRESHOLD_FLAGS.items()
}
INTERACTIONS = {
    name: " * ".join(f if isinstance(f, str) else f"({sql_is(*f)})" for f in factors)
    for name, factors in specs.INTERACTIONS.items()
}
ONE_HOT = {name: sql_is(column, value) for column, names in specs.ONE_HOT.items() for name, value in names.items()}
RELATIVES = {name: sql_ratio(*parts) for name, parts in specs.RELATIVES.items()}

CONTEXT = (
    "by_dept AS (SELECT department, " + _named(
        {name: f"AVG({m})" for name, m in specs.DEPARTMENT_CONTEXT.items()} | {specs.DEPARTMENT_HEADCOUNT: "COUNT(*)"}
    ) + " FROM silver GROUP BY department),\n"
    "by_role AS (SELECT job_role, " + _named(
        {name: f"AVG({m})" for name, m in specs.ROLE_CONTEXT.items()} | {specs.ROLE_HEADCOUNT: "COUNT(*)"}
    ) + " FROM silver GROUP BY job_role)"
)
FEATURES = "features AS (SELECT attrition, " + ", ".join(
    [*specs.NUMERIC_FEATURES, *specs.BINARY_FEATURES]
) + ", " + _named(RATIOS | COMPOSITES | FLAGS | INTERACTIONS) + ", " + ", ".join(
    c for c in specs.CONTEXT_FEATURES if c not in specs.RELATIVES
) + ", " + _named(RELATIVES | ONE_HOT) + f""", {specs.KEY}
  FROM silver s LEFT JOIN by_dept USING (department) LEFT JOIN by_role USING (job_role))"""


def dim_sql(name: str) -> str:
    key, columns, order = star.DIMENSIONS[name]
    picked = ", ".join(f"{old} AS {new}" for old, new in columns.items())
    return (
        f"SELECT ROW_NUMBER() OVER (ORDER BY {', '.join(o + ' NULLS FIRST' for o in order)}) AS {key}, "
        f"{', '.join(columns.values())} FROM (SELECT DISTINCT {picked} FROM silver)"
    )


DIMS = ",\n".join(f"{name} AS ({dim_sql(name)})" for name in star.DIMENSIONS)

LABELS = {
    "attrition_label": "CASE WHEN attrition = 1 THEN 'Yes' ELSE 'No' END",
    "age_band": sql_band("age", specs.AGE_BAND),
    "gender_label": "CASE WHEN gender = 1 THEN 'Male' ELSE 'Female' END",
    "overtime_label": "CASE WHEN overtime = 1 THEN 'Yes' ELSE 'No' END",
    "education_label": sql_decode("education", specs.EDUCATION_LABELS),
    "income_quartile": sql_band("monthly_income", specs.INCOME_BAND),
    "tenure_band": sql_band("years_at_company", specs.TENURE_BAND_4),
    "income_per_experience_year": sql_round_ratio("monthly_income", "total_working_years", 2),
    "company_loyalty_ratio": sql_round_ratio("years_at_company", "total_working_years", 4),
    "years_before_current_role": "years_at_company - years_in_current_role",
}
LABELLED = "labelled AS (SELECT *, " + _named(LABELS) + " FROM silver)"


def key_sql(order: Sequence[str]) -> str:
    return f"ROW_NUMBER() OVER (ORDER BY {', '.join(c + ' NULLS FIRST' for c in order)})"


FACT = (
    f"fact AS (SELECT {key_sql(['s.' + c for c in [*specs.FACT_ORDER, specs.KEY]])} AS employee_key, "
    + ", ".join(("s." if c not in star_key else "") + c for star_key in [
        [spec[0] for spec in star.DIMENSIONS.values()]
    ] for c in specs.FACT_COLUMNS[1:])
    + """
  FROM labelled s
  LEFT JOIN dim_department d ON s.department = d.department_name
  LEFT JOIN dim_job_role r ON s.job_role = r.job_role_name AND s.department = r.department_name
  LEFT JOIN dim_education_field e ON s.education_field = e.education_field_name
  LEFT JOIN dim_marital_status m ON s.marital_status = m.marital_status_name
  LEFT JOIN dim_business_travel t ON s.business_travel = t.business_travel_name)"""
)


def card_sql(card: str) -> str:
    weights, intercept = CARDS[card]
    terms = [repr(float(intercept))] + [f"CAST(COALESCE({c}, 0) AS DOUBLE) * {w!r}::DOUBLE" for c, w in weights.items()]
    z = terms[0] + "::DOUBLE"
    for term in terms[1:]:
        z = f"({z} + {term})"
    return f"1.0::DOUBLE / (1.0::DOUBLE + EXP(-({z})))"


SCORED = f"scored AS (SELECT *, {card_sql('Full Card')} AS probability FROM features)"
CARD_ROWS = "cards AS (" + " UNION ALL ".join(
    f"SELECT {specs.KEY}, attrition, {literal(card)} AS model, ROUND({card_sql(card)}, 4) AS score, "
    f"CASE WHEN {card_sql(card)} > 0.5 THEN 1 ELSE 0 END AS prediction FROM features" for card in CARDS
) + ")"


def _decode_one_hot(column: str) -> str:
    tests = " ".join(f"WHEN {n} = 1 THEN {literal(v)}" for n, v in specs.ONE_HOT[column].items())
    return f"CASE {tests} ELSE {literal(specs.DECODE_DEFAULTS[column])} END"


RISK = "risk AS (SELECT *, " + _named(
    {f"{c}_name": _decode_one_hot(c) for c in specs.DECODE_DEFAULTS}
    | {n: LABELS[n] for n in ("overtime_label", "gender_label", "attrition_label")}
    | {
        "attrition_probability": "ROUND(probability, 4)",
        "predicted_attrition": "CASE WHEN probability > 0.5 THEN 1 ELSE 0 END",
        "risk_tier": sql_band("ROUND(probability, 4)", specs.RISK_TIER),
    }
) + " FROM scored)"
PREDICTIONS = (
    f"predictions AS (SELECT {key_sql([*specs.PREDICTION_ORDER, specs.KEY])} AS employee_key, "
    + ", ".join(specs.PREDICTION_COLUMNS[1:]) + " FROM risk)"
)

_BASE = [PEOPLE, SILVER]
_ALL = {
    "people": [PEOPLE],
    "silver": _BASE,
    "context": [*_BASE, CONTEXT],
    "features": [*_BASE, CONTEXT, FEATURES],
    "labelled": [*_BASE, LABELLED],
    "dims": [*_BASE, DIMS],
    "fact": [*_BASE, LABELLED, DIMS, FACT],
    "cards": [*_BASE, CONTEXT, FEATURES, CARD_ROWS],
    "risk": [*_BASE, CONTEXT, FEATURES, SCORED, RISK],
    "predictions": [*_BASE, CONTEXT, FEATURES, SCORED, RISK, PREDICTIONS],
    "everything": [*_BASE, CONTEXT, FEATURES, LABELLED, DIMS, FACT, SCORED, RISK, PREDICTIONS],
}


def sql(prelude: str, body: str, *more: str) -> str:
    """A query on top of the named prelude; ``more`` holds further ``name AS (...)`` parts."""
    return exact_means("WITH " + ",\n".join([*_ALL[prelude], *more]) + "\n" + body)


def exact_means(text: str) -> str:
    """Means of whole numbers as sum / count: correctly rounded, unlike AVG here."""
    return re.sub(r"AVG\(([^()]+)\)", r"(CAST(SUM(\1) AS DOUBLE) / COUNT(\1))", text)


# --- tail probabilities by quadrature: SQL engines have no such functions -----------

_STEPS = 2000


def _simpson(f: str, upper: str) -> str:
    """Integral of f(u) from 0 to upper."""
    return (
        f"(SELECT SUM((CASE WHEN i = 0 OR i = {_STEPS} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * g) "
        f"* ({upper}) / {_STEPS} / 3 FROM (SELECT i, {f.replace('<u>', f'((i * 1.0::DOUBLE) * ({upper}) / {_STEPS})')} AS g "
        f"FROM range(0, {_STEPS + 1}) AS steps(i)))"
    )


def sql_student_p(t: str, dof: str) -> str:
    scale = f"EXP(LGAMMA(({dof} + 1) / 2.0) - LGAMMA({dof} / 2.0)) / SQRT({dof} * PI())"
    return f"1 - 2 * {scale} * {_simpson(f'POW(1 + <u> * <u> / {dof}, -({dof} + 1) / 2.0)', f'ABS({t})')}"


def sql_chi2_p(x: str, dof: str) -> str:
    # in logarithms, and no farther than the density reaches: neither many degrees of
    # freedom nor a strong association leaves the range of a double
    scale = f"LGAMMA({dof} / 2.0) + ({dof} / 2.0 - 1) * LN(2)"
    density = (
        f"CASE WHEN <u> = 0 THEN CASE WHEN {dof} = 1 THEN EXP(-({scale})) ELSE 0 END "
        f"ELSE EXP(({dof} - 1) * LN(<u>) - <u> * <u> / 2 - ({scale})) END"
    )
    return f"GREATEST(0, 1 - {_simpson(density, f'LEAST(SQRT({x}), SQRT({dof}) + 12)')})"


def sql_normal_p(z: str) -> str:
    return f"1 - 2 * {_simpson('EXP(-<u> * <u> / 2)', z)} / SQRT(2 * PI())"
