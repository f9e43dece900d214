"""Sources, tables, projections, filters, scalar expressions, joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import (
    COMPOSITES, FLAGS, INTERACTIONS, ONE_HOT, RATIOS, RELATIVES,
    clean, feature_rows, key_sql, labelled, literal, new_lake, over, raw, rounded, sql,
    sql_band, sql_decode, sql_is, sql_round_ratio, table,
)
from tenura import specs
from tenura.functions import encode
from tenura.functions.arithmetic import ratio
from tenura.operators import columns, joins, topk
from tenura.operators.aggregate import row_count, value_counts
from tenura.operators.distinct import facts
from tenura.plans import data_tests, features, flow, registry, star
from tenura.session import scratch_path
from tenura.sources import readers

QUERIES: dict = {}
ORACLE: dict = {}


def add(name, query, text=None):
    QUERIES[name] = query
    if text is not None:
        ORACLE[name] = text


KEY = specs.KEY
RAW_LIST = ", ".join(specs.RAW_COLUMNS)


# --- sources, sinks, catalog -----------------------------------------------------

def _csv(spark, sf_dir):
    path = scratch_path(spark, "people-csv")
    raw(spark, sf_dir).write.option("header", True).csv(path)
    return path


def scan_csv(spark, sf_dir):
    return readers.scan_csv(spark, _csv(spark, sf_dir), specs.RAW_SCHEMA)


def scan_csv_reordered(spark, sf_dir):
    """Columns are found by the header, whatever their order in the file."""
    path = scratch_path(spark, "people-csv")
    raw(spark, sf_dir).select(*reversed(specs.RAW_COLUMNS)).write.option("header", True).csv(path)
    return readers.scan_csv(spark, path, specs.RAW_SCHEMA)


def scan_csv_rejects(spark, sf_dir):
    """Cells that don't fit their column's type, per column."""
    path = scratch_path(spark, "people-csv")
    people = raw(spark, sf_dir)
    spoilt = F.when(F.col("EmployeeNumber") % 100 == 0, "oops").otherwise(F.col("Age").cast("string"))
    people.withColumn("Age", spoilt).write.option("header", True).csv(path)
    return readers.rejects(spark, path, specs.RAW_SCHEMA)


def scan_csv_inferred(spark, sf_dir):
    """Types found by the extra pass; the key is narrowed to int, as its values fit."""
    found = readers.scan_csv(spark, _csv(spark, sf_dir))
    return found.withColumn("EmployeeNumber", F.col("EmployeeNumber").cast("bigint"))


def scan_first_available(spark, sf_dir):
    there = _csv(spark, sf_dir)
    return readers.scan_first_available(spark, [f"{there}-missing", there], specs.RAW_SCHEMA)


def ingest_config(spark, sf_dir):
    lake = new_lake(spark)
    path = _csv(spark, sf_dir)
    return lake.ingest([
        {"path": path, "table": "bronze.people", "schema": specs.RAW_SCHEMA},
        {"path": path, "table": "bronze.people_inferred"},
    ])


_ODD = {"MonthlyIncome": "Monthly Income", "JobRole": "Job-Role", "Age": "Age(years)", "OverTime": "Over=Time",
        "Department": "Department;name", "Gender": "{Gender}"}
_EVEN = {"MonthlyIncome": "Monthly_Income", "JobRole": "Job_Role", "Age": "Age_years_", "OverTime": "Over_Time",
         "Department": "Department_name", "Gender": "_Gender_"}


def sanitize_columns(spark, sf_dir):
    odd = raw(spark, sf_dir).select("EmployeeNumber", *[F.col(c).alias(o) for c, o in _ODD.items()])
    return columns.sanitize_columns(odd)


def write_table(spark, sf_dir):
    lake = new_lake(spark)
    lake.write(raw(spark, sf_dir).select("Age", "Attrition"), "silver.people_clean")
    lake.write(clean(spark, sf_dir), "silver.people_clean")  # replaces rows and schema
    return lake.read("silver.people_clean")


def ctas(spark, sf_dir):
    lake = new_lake(spark)
    lake.create_view(clean(spark, sf_dir), "silver.people_clean")
    view = lake.full_name("silver.people_clean").replace(".", "_")
    lake.create_as("gold.department_size", f"SELECT department, COUNT(*) AS n FROM {view} GROUP BY department")
    return lake.read("gold.department_size")


def create_schema(spark, sf_dir):
    lake = new_lake(spark)
    for layer in ("bronze", "silver", "gold"):
        lake.create_schema(layer)
        lake.create_schema(layer)  # a second time does nothing
        lake.write(value_counts(raw(spark, sf_dir), "Department").select("Department", "n"), f"{layer}.departments")
    parts = [lake.read(f"{layer}.departments").withColumn("layer", F.lit(layer)) for layer in ("bronze", "silver", "gold")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def skip_if_loaded(spark, sf_dir):
    lake = new_lake(spark)
    source = raw(spark, sf_dir)
    rows = source.count()
    attempts = []
    for attempt, expected in ((1, rows), (2, rows), (3, 1)):
        said = flow.load_raw(lake, source, expected)
        attempts.append((attempt, said.startswith("already"), lake.read(data_tests.RAW).count()))
    return spark.createDataFrame(attempts, "attempt int, skipped boolean, n_rows bigint")


def scan_table(spark, sf_dir):
    lake = new_lake(spark)
    lake.write(raw(spark, sf_dir), "bronze.people", partition_by=["Department"])
    return lake.read("bronze.people").select(*specs.RAW_COLUMNS)


def layer_routing(spark, sf_dir):
    lake = new_lake(spark)
    lake.create_view(raw(spark, sf_dir), data_tests.RAW)
    built = registry.build(lake, ["silver", "dimension", "analytics"])
    models = {m.name: m for m in registry.MODELS}
    rows = [(name, models[name].layer, models[name].materialize, lake.read(name).count()) for name in built]
    return spark.createDataFrame(rows, "model string, layer string, materialize string, n_rows bigint")


add("scan_csv", scan_csv, sql("people", f"SELECT {RAW_LIST} FROM people"))
add("scan_csv_reordered", scan_csv_reordered, sql("people", f"SELECT {RAW_LIST} FROM people"))
add("scan_csv_rejects", scan_csv_rejects, sql("people", f"""
SELECT column_name, CASE WHEN column_name = 'Age' THEN (SELECT COUNT(*) FROM people WHERE EmployeeNumber % 100 = 0) ELSE 0 END AS n_rejected
FROM (SELECT UNNEST([{', '.join(literal(c) for c in specs.RAW_COLUMNS)}]) AS column_name)"""))
add("scan_csv_inferred", scan_csv_inferred, sql("people", f"SELECT {RAW_LIST} FROM people"))
add("scan_first_available", scan_first_available, sql("people", f"SELECT {RAW_LIST} FROM people"))
add("ingest_config", ingest_config, sql("people", """
SELECT t.table_name, COUNT(*) AS n_rows, CAST(35 AS BIGINT) AS n_columns
FROM people CROSS JOIN (VALUES ('bronze.people'), ('bronze.people_inferred')) t(table_name) GROUP BY 1"""))
add("sanitize_columns", sanitize_columns,
    sql("people", "SELECT EmployeeNumber, " + ", ".join(f"{c} AS {e}" for c, e in _EVEN.items()) + " FROM people"))
add("write_table", write_table, sql("silver", "SELECT * FROM silver"))
add("ctas", ctas, sql("silver", "SELECT department, COUNT(*) AS n FROM silver GROUP BY department"))
add("create_schema", create_schema, sql("people", """
SELECT l.layer, Department, COUNT(*) AS n FROM people CROSS JOIN (VALUES ('bronze'), ('silver'), ('gold')) l(layer)
GROUP BY 1, 2"""))
add("skip_if_loaded", skip_if_loaded, sql("people", """
SELECT a.attempt, a.attempt > 1 AS skipped, COUNT(*) AS n_rows
FROM people CROSS JOIN (VALUES (1), (2), (3)) a(attempt) GROUP BY 1, 2"""))
add("scan_table", scan_table, sql("people", f"SELECT {RAW_LIST} FROM people"))


def _dimension_rows() -> str:
    return " UNION ALL ".join(
        f"SELECT 'gold.{name}' AS model, 'gold' AS layer, 'table' AS materialize, COUNT(*) AS n_rows FROM {name}"
        for name in star.DIMENSIONS
    )


def _analytics_rows() -> str:
    values = {
        "department": "department", "role": "job_role", "overtime": "overtime", "marital": "marital_status",
        "gender": "gender", "level": "job_level", "age": sql_band("age", specs.AGE_BAND),
        "tenure": sql_band("years_at_company", specs.TENURE_BAND_5),
        "income": sql_band("monthly_income", specs.INCOME_BAND_NAMED), "travel": "business_travel",
        "education": "education", "stock": "stock_option_level",
        "distance": sql_band("distance_from_home", specs.DISTANCE_BAND),
    }
    return " + ".join(["1"] + [f"COUNT(DISTINCT {v})" for v in values.values()])


add("layer_routing", layer_routing, sql("dims", f"""
SELECT 'silver.people_clean' AS model, 'silver' AS layer, 'table' AS materialize, COUNT(*) AS n_rows FROM silver
UNION ALL SELECT 'gold.attrition_analytics', 'gold', 'table', {_analytics_rows()} FROM silver
UNION ALL {_dimension_rows()}"""))
add("preview", over(lambda df: topk.preview(df, "EmployeeNumber"), raw),
    sql("people", f"SELECT {RAW_LIST} FROM people ORDER BY EmployeeNumber LIMIT 5"))

# --- projections and scalar expressions --------------------------------------------

add("silver_clean", clean, sql("silver", "SELECT * FROM silver"))
add("rename_snake", over(lambda df: columns.rename_columns(df, specs.RENAMES), raw), sql(
    "people", "SELECT " + ", ".join(
        f"{c} AS {specs.RENAMES[c]}" if c in specs.RENAMES else c for c in specs.RAW_COLUMNS) + " FROM people"))
_dropped = [*specs.CONSTANT_COLUMNS, specs.ID_COLUMN]
add("drop_columns", over(lambda df: columns.drop_columns(df, _dropped), raw), sql(
    "people", "SELECT " + ", ".join(c for c in specs.RAW_COLUMNS if c not in _dropped) + " FROM people"))
add("binary_encode", over(lambda df: df.select(
        "EmployeeNumber", *[encode.binary_flag(c, yes).alias(n) for n, (c, yes) in specs.FLAGS.items()]), raw),
    sql("people", "SELECT EmployeeNumber, " + ", ".join(
        f"{sql_is(c, yes)} AS {n}" for n, (c, yes) in specs.FLAGS.items()) + " FROM people"))
# one level is left out of the order, so that unmatched values show as null
_PART = {k: v for k, v in specs.TRAVEL_ORDER.items() if k != "Travel_Rarely"}
add("ordinal_encode", over(lambda df: df.select(
        "EmployeeNumber", encode.decode("BusinessTravel", specs.TRAVEL_ORDER).alias("travel"),
        encode.decode("BusinessTravel", _PART).alias("travel_partial")), raw),
    sql("people", f"""SELECT EmployeeNumber, {sql_decode('BusinessTravel', specs.TRAVEL_ORDER)} AS travel,
    {sql_decode('BusinessTravel', _PART)} AS travel_partial FROM people"""))

for _name, _column, _bands in (
    ("band_age", "age", {"band": specs.AGE_BAND}),
    ("band_income", "monthly_income", {"band": specs.INCOME_BAND, "band_named": specs.INCOME_BAND_NAMED}),
    ("band_tenure4", "years_at_company", {"band": specs.TENURE_BAND_4}),
    ("band_tenure5", "years_at_company", {"band": specs.TENURE_BAND_5}),
    ("band_distance", "distance_from_home", {"band": specs.DISTANCE_BAND}),
):
    add(_name,
        over(lambda df, c=_column, b=_bands: df.select(KEY, c, *[encode.band(c, s).alias(n) for n, s in b.items()]), clean),
        sql("silver", f"SELECT {KEY}, {_column}, " + ", ".join(
            f"{sql_band(_column, s)} AS {n}" for n, s in _bands.items()) + " FROM silver"))

add("decode_labels", over(lambda df: df.select(
        KEY, "attrition_label", "gender_label", "overtime_label", "education_label"), labelled),
    sql("labelled", f"SELECT {KEY}, attrition_label, gender_label, overtime_label, education_label FROM labelled"))


def _some(names: dict) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in names.items())


add("ratio_features", over(lambda df: df.select(KEY, *features.ratio_columns()), clean),
    sql("silver", f"SELECT {KEY}, {_some(RATIOS)} FROM silver"))
add("composite_scores", over(lambda df: df.select(KEY, *features.composite_columns()), clean),
    sql("silver", f"SELECT {KEY}, " + _some({n: f"CAST({e} AS DOUBLE)" for n, e in COMPOSITES.items()}) + " FROM silver"))
add("threshold_flags", over(lambda df: df.select(KEY, *features.flag_columns()), clean),
    sql("silver", f"SELECT {KEY}, {_some(FLAGS)} FROM silver"))
add("interaction_features", over(lambda df: df.select(KEY, *features.interaction_columns()), clean),
    sql("silver", f"SELECT {KEY}, {_some(INTERACTIONS)} FROM silver"))
add("one_hot", over(lambda df: df.select(KEY, *features.one_hot_columns()), clean),
    sql("silver", f"SELECT {KEY}, {_some(ONE_HOT)} FROM silver"))
add("one_hot_decode", over(lambda df: df.select(KEY, *features.one_hot_columns()).select(
        KEY, *[encode.one_hot_decode(specs.ONE_HOT[c], d).alias(c) for c, d in specs.DECODE_DEFAULTS.items()]), clean),
    sql("silver", f"SELECT {KEY}, department, job_role, marital_status FROM silver"))
_DERIVED = ["income_per_experience_year", "company_loyalty_ratio", "years_before_current_role"]
add("derived_measures", over(lambda df: df.select(KEY, *_DERIVED), labelled),
    sql("labelled", f"SELECT {KEY}, {', '.join(_DERIVED)} FROM labelled"))
add("relative_to_group", over(lambda df: rounded(
        features.with_group_context(df).select(KEY, *features.relative_columns()), *RELATIVES, places=9), clean),
    sql("context", f"SELECT {KEY}, " + _some({n: f"ROUND({e}, 9)" for n, e in RELATIVES.items()})
        + " FROM silver LEFT JOIN by_dept USING (department)"))


def fill_nulls(spark, sf_dir):
    """Ratios over zero experience are null; filled after being counted as such."""
    names = ["income_per_experience_year", "company_loyalty_ratio"]
    rows = labelled(spark, sf_dir).select(KEY, *names)
    return columns.fill_nulls(rows, names)


add("fill_nulls", fill_nulls, sql("labelled", f"""
SELECT {KEY}, COALESCE(income_per_experience_year, 0) AS income_per_experience_year,
  COALESCE(company_loyalty_ratio, 0) AS company_loyalty_ratio FROM labelled"""))


def select_by_type(spark, sf_dir):
    """Each column's kind, and how many of its rows have a value."""
    people = raw(spark, sf_dir)
    values = facts(people, people.columns).select(F.col("feature").alias("column_name"), "non_null", "constant")
    return columns.column_kinds(people, specs.CATEGORICAL_EXCLUDED).join(values, "column_name")


add("select_by_type", select_by_type, sql("people", " UNION ALL ".join(
    f"SELECT {i} AS position, {literal(p.split()[0])} AS column_name, {literal(p.split()[1].lower())} AS dtype, "
    f"{literal('string' if p.split()[1] == 'STRING' else 'numeric')} AS kind, "
    f"{str(p.split()[0] in specs.CATEGORICAL_EXCLUDED).upper()} AS excluded, COUNT({p.split()[0]}) AS non_null, "
    f"COUNT(DISTINCT {p.split()[0]}) <= 1 AS constant FROM people"
    for i, p in enumerate(specs.RAW_SCHEMA.split(","), 1))))


def cut_risk_tier(spark, sf_dir):
    from checks.common import risk_rows
    return risk_rows(spark, sf_dir).select(KEY, "attrition_probability", "risk_tier")


add("cut_risk_tier", cut_risk_tier, sql("risk", f"SELECT {KEY}, attrition_probability, risk_tier FROM risk"))


def filters(spark, sf_dir):
    """Equality, two-condition mask, pair null-drop and a threshold, stacked."""
    rows = labelled(spark, sf_dir)
    pair = columns.complete_rows(rows, ["company_loyalty_ratio", "attrition"])
    return pair.filter(
        (F.col("attrition") == 1) & (F.col("overtime") == 1) & (F.abs(F.col("company_loyalty_ratio")) < 0.3)
    ).select(KEY, "company_loyalty_ratio")


add("filters", filters, sql("labelled", f"""
SELECT {KEY}, company_loyalty_ratio FROM labelled
WHERE company_loyalty_ratio IS NOT NULL AND attrition = 1 AND overtime = 1 AND ABS(company_loyalty_ratio) < 0.3"""))


def scalar_surface(spark, sf_dir):
    return clean(spark, sf_dir).select(
        KEY,
        (F.col("monthly_income") + F.col("age") - F.col("job_level") * 2).alias("arithmetic"),
        ratio("monthly_income", F.col("total_working_years")).alias("guarded"),
        F.round(ratio("monthly_income", F.col("age")), 2).alias("rounded"),
        F.when(F.col("age").between(25, 34) & (F.col("overtime") == 1), "young overtime").otherwise("other").alias("searched"),
        F.col("job_level").cast("string").alias("as_text"),
        F.abs(F.col("age") - 40).alias("absolute"),
        F.sqrt(F.col("age").cast("double")).alias("root"),
        F.least("years_at_company", "total_working_years").alias("smaller"),
        F.lit("fixed").alias("constant"),
    )


add("scalar_surface", scalar_surface, sql("silver", f"""
SELECT {KEY}, monthly_income + age - job_level * 2 AS arithmetic,
  CAST(monthly_income AS DOUBLE) / NULLIF(total_working_years, 0) AS guarded,
  {sql_round_ratio("monthly_income", "age", 2)} AS rounded,
  CASE WHEN age BETWEEN 25 AND 34 AND overtime = 1 THEN 'young overtime' ELSE 'other' END AS searched,
  CAST(job_level AS VARCHAR) AS as_text, ABS(age - 40) AS absolute, SQRT(CAST(age AS DOUBLE)) AS root,
  LEAST(years_at_company, total_working_years) AS smaller, 'fixed' AS constant FROM silver"""))

# --- joins --------------------------------------------------------------------------

_FK = [spec[0] for spec in star.DIMENSIONS.values()]


def fact_star_join(spark, sf_dir):
    rows = clean(spark, sf_dir)
    return star.with_dimension_keys(rows, star.dimensions(rows)).select(KEY, *_FK)


add("fact_star_join", fact_star_join, sql("fact", f"""
SELECT s.{KEY}, {', '.join(_FK)} FROM silver s
  LEFT JOIN dim_department d ON s.department = d.department_name
  LEFT JOIN dim_job_role r ON s.job_role = r.job_role_name AND s.department = r.department_name
  LEFT JOIN dim_education_field e ON s.education_field = e.education_field_name
  LEFT JOIN dim_marital_status m ON s.marital_status = m.marital_status_name
  LEFT JOIN dim_business_travel t ON s.business_travel = t.business_travel_name"""))


def composite_key_join(spark, sf_dir):
    rows = clean(spark, sf_dir)
    roles = star.dimension(rows, "dim_job_role")
    on = {"job_role": "job_role_name", "department": "department_name"}
    return joins.lookup_join(rows.select(KEY, "job_role", "department"), roles, on)


add("composite_key_join", composite_key_join, sql("dims", f"""
SELECT {KEY}, job_role, department, job_role_key FROM silver s
LEFT JOIN dim_job_role r ON s.job_role = r.job_role_name AND s.department = r.department_name"""))
_context = [c for c in specs.CONTEXT_FEATURES if c not in specs.RELATIVES]
_means = [c for c in _context if "headcount" not in c]
add("join_back_aggregates", over(lambda df: rounded(
        features.with_group_context(df).select(KEY, *_context), *_means, places=9), clean),
    sql("context", f"SELECT {KEY}, " + ", ".join(
        f"ROUND({c}, 9) AS {c}" if c in _means else c for c in _context)
        + " FROM silver LEFT JOIN by_dept USING (department) LEFT JOIN by_role USING (job_role)"))


def ref_integrity(spark, sf_dir):
    """Orders without a customer, and line items without an order."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    lines = table(spark, sf_dir, "lineitem")
    found = [
        ("orders.o_custkey", joins.orphans(orders, "o_custkey", customer, "c_custkey")),
        ("lineitem.l_orderkey", joins.orphans(lines, "l_orderkey", orders, "o_orderkey")),
        # a parent that lacks some keys on purpose
        ("lineitem.l_orderkey to F orders",
         joins.orphans(lines, "l_orderkey", orders.filter("o_orderstatus = 'F'"), "o_orderkey")),
    ]
    parts = [row_count(df).select(F.lit(name).alias("relation"), F.col("n_rows").alias("orphans")) for name, df in found]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


add("ref_integrity", ref_integrity, """
SELECT 'orders.o_custkey' AS relation, COUNT(*) AS orphans FROM orders
  WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'lineitem.l_orderkey', COUNT(*) FROM lineitem
  WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'lineitem.l_orderkey to F orders', COUNT(*) FROM lineitem
  WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")

# --- the models that are wide projections ----------------------------------------------

_wide = ["attrition", *specs.FEATURE_COLUMNS, KEY]
_inexact = [*_means, *specs.RELATIVES]
add("ml_features", over(lambda df: rounded(df, *_inexact, places=9), feature_rows),
    sql("features", "SELECT " + ", ".join(
        f"ROUND({c}, 9) AS {c}" if c in _inexact else
        f"CAST({c} AS DOUBLE) AS {c}" if c in specs.COMPOSITES else c for c in _wide) + " FROM features"))
add("fact", over(star.fact, clean), sql("fact", "SELECT * FROM fact"))
for _dim in star.DIMENSIONS:
    add(_dim, over(lambda df, d=_dim: star.dimension(df, d), clean), sql("dims", f"SELECT * FROM {_dim}"))


def dense_surrogate_key(spark, sf_dir):
    from tenura.operators.ordering import dense_key
    order = [*specs.FACT_ORDER, KEY]
    return dense_key(clean(spark, sf_dir).select(*order), order, "employee_key")


add("dense_surrogate_key", dense_surrogate_key, sql(
    "silver", f"SELECT {', '.join(specs.FACT_ORDER)}, {KEY}, {key_sql([*specs.FACT_ORDER, KEY])} AS employee_key FROM silver"))


def dense_key_lineitem(spark, sf_dir):
    """Numbering of a table by price, ties broken by its remaining columns."""
    from tenura.operators.ordering import dense_key
    order = ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"]
    return dense_key(table(spark, sf_dir, "lineitem").select(*order), order, "place").select(
        "place", "l_extendedprice", "l_orderkey", "l_linenumber")


add("dense_key_lineitem", dense_key_lineitem, f"""
SELECT {key_sql(["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"])} AS place,
  l_extendedprice, l_orderkey, l_linenumber FROM lineitem""")


def sort_and_number(spark, sf_dir):
    from checks.common import risk_rows
    from tenura.operators.ordering import dense_key
    rows = risk_rows(spark, sf_dir).select(*specs.PREDICTION_ORDER, KEY, "attrition_probability")
    return dense_key(rows, [*specs.PREDICTION_ORDER, KEY], "employee_key")


add("sort_and_number", sort_and_number, sql("risk", f"""
SELECT {', '.join(specs.PREDICTION_ORDER)}, {KEY}, attrition_probability,
  {key_sql([*specs.PREDICTION_ORDER, KEY])} AS employee_key FROM risk"""))
