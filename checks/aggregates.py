"""Cuts, grouped aggregates, counts, pivots, histograms, sorts, duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import (
    CATEGORICAL, NUMERIC, clean, flagged, labelled, literal, over, raw, rounded, sql, sql_band,
    sql_decode, table,
)
from tenura import specs
from tenura.functions.encode import Band, band
from tenura.operators import aggregate, topk
from tenura.plans import analytics

QUERIES: dict = {}
ORACLE: dict = {}


def add(name, query, text=None):
    QUERIES[name] = query
    if text is not None:
        ORACLE[name] = text


KEY = specs.KEY

# --- cuts -----------------------------------------------------------------------

METRICS_SQL = (
    "COUNT(*) AS total_employees, CAST(SUM(attrition) AS BIGINT) AS attrition_count, "
    "AVG(attrition) * 100 AS attrition_rate, AVG(age) AS avg_age, AVG(monthly_income) AS avg_income, "
    "AVG(total_working_years) AS avg_experience, AVG(years_at_company) AS avg_tenure"
)
CUT_VALUES = {
    "Overall": "'All Employees'",
    "Department": "department",
    "Job Role": "job_role",
    "OverTime": "CASE WHEN overtime = 1 THEN 'Yes' ELSE 'No' END",
    "Marital Status": "marital_status",
    "Gender": "CASE WHEN gender = 1 THEN 'Male' ELSE 'Female' END",
    "Job Level": "CAST(job_level AS VARCHAR)",
    "Age Band": sql_band("age", specs.AGE_BAND),
    "Tenure Band": sql_band("years_at_company", specs.TENURE_BAND_5),
    "Income Quartile": sql_band("monthly_income", specs.INCOME_BAND_NAMED),
    "Business Travel": "business_travel",
    "Education Level": sql_decode("education", specs.EDUCATION_LABELS),
    "Stock Option Level": "CAST(stock_option_level AS VARCHAR)",
    "Distance From Home": sql_band("distance_from_home", specs.DISTANCE_BAND),
}


def _cut_sql(name: str) -> str:
    return (
        f"SELECT {literal(name)} AS dimension_name, {CUT_VALUES[name]} AS dimension_value, {METRICS_SQL} "
        f"FROM silver GROUP BY 1, 2"
    )


_CUT_KEYS = {
    "cut_overall": "Overall", "cut_department": "Department", "cut_job_role": "Job Role",
    "cut_overtime": "OverTime", "cut_marital": "Marital Status", "cut_gender": "Gender",
    "cut_job_level": "Job Level", "cut_age_band": "Age Band", "cut_tenure_band": "Tenure Band",
    "cut_income_quartile": "Income Quartile", "cut_travel": "Business Travel",
    "cut_education": "Education Level", "cut_stock": "Stock Option Level",
    "cut_distance_band": "Distance From Home",
}
for _key, _dimension in _CUT_KEYS.items():
    add(_key, over(lambda df, d=_dimension: analytics.one_cut(df, d), clean), sql("silver", _cut_sql(_dimension)))

add("metric_set", over(lambda df: df.groupBy("department", "overtime").agg(*analytics.metrics()), clean),
    sql("silver", f"SELECT department, overtime, {METRICS_SQL} FROM silver GROUP BY 1, 2"))
_all_cuts = " UNION ALL ".join(_cut_sql(name) for name in CUT_VALUES)
add("attrition_analytics", over(analytics.attrition_analytics, clean), sql("silver", _all_cuts))
add("union_all", over(analytics.attrition_analytics_by_union, clean), sql("silver", _all_cuts))

_PRICE_BAND = Band([50_000, 100_000, 200_000], ["small", "medium", "large", "huge"], closed="left")


def order_cuts(spark, sf_dir):
    """The one-pass cuts over another table: orders by status, priority and price band."""
    orders = table(spark, sf_dir, "orders")
    urgent = orders.withColumn("urgent", F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0))
    dimensions = {
        "All": F.lit("all"), "Status": F.col("o_orderstatus"), "Priority": F.col("o_orderpriority"),
        "Price": band("o_totalprice", _PRICE_BAND),
    }
    metrics = [
        F.count(F.lit(1)).alias("n"), F.sum("urgent").alias("urgent"), (F.avg("urgent") * 100).alias("urgent_pct"),
        F.round(F.avg("o_totalprice"), 4).alias("avg_price"),
    ]
    return aggregate.cuts(urgent, dimensions, ["urgent", "o_totalprice"], metrics)


add("order_cuts", order_cuts, " UNION ALL ".join(
    f"SELECT {literal(name)} AS dimension_name, {value} AS dimension_value, COUNT(*) AS n, "
    "COUNT(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent, "
    "AVG(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) * 100 AS urgent_pct, "
    "ROUND(AVG(o_totalprice), 4) AS avg_price FROM orders GROUP BY 1, 2"
    for name, value in {"All": "'all'", "Status": "o_orderstatus", "Priority": "o_orderpriority",
                        "Price": sql_band("o_totalprice", _PRICE_BAND)}.items()))

# --- group aggregates -----------------------------------------------------------------

add("dept_aggregates", over(lambda df: aggregate.group_means(
        df, "department", specs.DEPARTMENT_CONTEXT, specs.DEPARTMENT_HEADCOUNT), clean),
    sql("context", "SELECT * FROM by_dept"))
add("role_aggregates", over(lambda df: aggregate.group_means(
        df, "job_role", specs.ROLE_CONTEXT, specs.ROLE_HEADCOUNT), clean),
    sql("context", "SELECT * FROM by_role"))
add("distinct_values", over(lambda df: aggregate.distinct_values(df, "job_role", "department"), clean),
    sql("silver", "SELECT DISTINCT job_role, department FROM silver"))
add("row_count", over(aggregate.row_count, raw),
    sql("people", "SELECT COUNT(*) AS n_rows, CAST(35 AS BIGINT) AS n_columns FROM people"))
add("value_counts", over(lambda df: aggregate.value_counts(df, "Attrition"), raw), sql("people", """
SELECT Attrition, COUNT(*) AS n, COUNT(*) * 100.0::DOUBLE / (SELECT COUNT(*) FROM people) AS pct
FROM people GROUP BY 1"""))
add("value_counts_events", lambda spark, sf_dir: aggregate.value_counts(table(spark, sf_dir, "events"), "event_type"), """
SELECT event_type, COUNT(*) AS n, COUNT(*) * 100.0::DOUBLE / (SELECT COUNT(event_type) FROM events) AS pct
FROM events WHERE event_type IS NOT NULL GROUP BY 1""")


def _rates_sql(columns) -> str:
    each = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS level, AVG(f) AS rate, COUNT(*) AS n, "
        f"(SELECT AVG(f) FROM fl) AS overall_rate FROM fl WHERE {c} IS NOT NULL GROUP BY 2" for c in columns
    )
    place = "CAST(ROW_NUMBER() OVER (PARTITION BY feature ORDER BY rate DESC, level) AS INT)"
    return f"SELECT *, {place} AS position FROM ({each})"


_FL = "fl AS (SELECT *, CASE WHEN Attrition = 'Yes' THEN 1 ELSE 0 END AS f FROM people)"
add("rate_by_category", over(lambda df: aggregate.rates(df, CATEGORICAL, "Attrition_Flag"), flagged),
    sql("people", _rates_sql(CATEGORICAL), _FL))
add("rate_by_ordinal", over(lambda df: aggregate.rates(df, specs.ORDINAL_COLUMNS, "Attrition_Flag"), flagged),
    sql("people", _rates_sql(specs.ORDINAL_COLUMNS), _FL))
add("worst_category", over(
        lambda df: aggregate.worst_levels(aggregate.rates(df, CATEGORICAL, "Attrition_Flag")), flagged),
    sql("people", """
SELECT feature, level, rate, n, overall_rate FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY feature ORDER BY rate DESC, level) AS place FROM rates)
WHERE place = 1 AND rate > overall_rate""", _FL, f"rates AS ({_rates_sql(CATEGORICAL)})"))

# --- pivots, medians ----------------------------------------------------------------------

add("pivot_rate", over(lambda df: aggregate.pivot_mean(
        df, "JobRole", "OverTime", {"No": "rate_no", "Yes": "rate_yes"}, F.col("Attrition_Flag") * 100), flagged),
    sql("people", """SELECT JobRole, AVG(CASE WHEN OverTime = 'No' THEN f * 100 END) AS rate_no,
    AVG(CASE WHEN OverTime = 'Yes' THEN f * 100 END) AS rate_yes FROM fl GROUP BY 1""", _FL))
add("pivot_median", over(lambda df: aggregate.pivot_median(
        df, "JobLevel", "Attrition", {"No": "median_no", "Yes": "median_yes"}, "MonthlyIncome"), raw),
    sql("people", """SELECT JobLevel,
    quantile_cont(MonthlyIncome, 0.5) FILTER (WHERE Attrition = 'No') AS median_no,
    quantile_cont(MonthlyIncome, 0.5) FILTER (WHERE Attrition = 'Yes') AS median_yes FROM people GROUP BY 1"""))
add("group_median_mean", over(lambda df: aggregate.center_by_class(df, "MonthlyIncome", "Attrition"), raw),
    sql("people", """SELECT Attrition, quantile_cont(MonthlyIncome, 0.5) AS median, AVG(MonthlyIncome) AS mean,
    COUNT(*) AS n FROM people GROUP BY 1"""))
add("median_gap", over(lambda df: aggregate.median_gap(df, "MonthlyIncome", "Attrition", "No", "Yes"), raw),
    sql("people", """
SELECT s.m AS median_high, l.m AS median_low, s.m - l.m AS median_gap,
  s.a AS mean_high, l.a AS mean_low, s.a - l.a AS mean_gap
FROM (SELECT quantile_cont(MonthlyIncome, 0.5) AS m, AVG(MonthlyIncome) AS a FROM people WHERE Attrition = 'No') s,
     (SELECT quantile_cont(MonthlyIncome, 0.5) AS m, AVG(MonthlyIncome) AS a FROM people WHERE Attrition = 'Yes') l"""))


def _describe_sql(source: str, columns) -> str:
    each = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, COUNT({c}) AS n, ROUND(AVG(CAST({c} AS DOUBLE)), 8) AS mean, "
        f"ROUND(STDDEV_SAMP({c}), 8) AS std, "
        f"MIN(CAST({c} AS DOUBLE)) AS min, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q25, "
        f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS q50, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q75, "
        f"MAX(CAST({c} AS DOUBLE)) AS max FROM {source}" for c in columns
    )
    return f"SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY mean DESC, feature) AS INT) AS position FROM ({each})"


add("describe", over(lambda df: rounded(aggregate.describe(df, NUMERIC), "mean", "std", places=8), raw),
    sql("people", _describe_sql("people", NUMERIC)))
# every numeric column of the table
_LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _round_quartiles(text: str) -> str:
    """Quartiles of fractional values differ in the last bit by the order of the blend."""
    for q in ("q25", "q50", "q75"):
        text = text.replace(f") AS {q},", f") AS raw_{q},")
    inner = ", ".join(f"ROUND(raw_{q}, 6) AS {q}" for q in ("q25", "q50", "q75"))
    return f"SELECT feature, n, mean, std, min, max, position, {inner} FROM ({text})"


def describe_lineitem(spark, sf_dir):
    described = aggregate.describe(table(spark, sf_dir, "lineitem"), _LINE)
    # a mean of hundredths can fall on a tie at six places (0.0399315), but not at eight
    return rounded(rounded(described, "mean", "std", places=8), "q25", "q50", "q75")


add("describe_lineitem", describe_lineitem, _round_quartiles(_describe_sql("lineitem", _LINE)))

# --- NaN is missing, infinities are values -----------------------------------------------------


def odd_numbers(spark, sf_dir):
    """People with a column of holes (NaN), one of infinities and one without any number."""
    key, income = F.col("EmployeeNumber"), F.col("MonthlyIncome").cast("double")
    return raw(spark, sf_dir).select(
        "EmployeeNumber", "Attrition", "JobLevel", "Age",
        F.when(key % 7 == 0, F.lit(float("nan"))).otherwise(income).alias("holed"),
        F.when(key % 1001 == 0, F.lit(float("-inf"))).when(key % 9 == 0, F.lit(None)).otherwise(income).alias("endless"),
        F.lit(float("nan")).alias("hollow"),
    )


_ODD = """odd AS (SELECT EmployeeNumber, Attrition, JobLevel, Age,
  CASE WHEN EmployeeNumber % 7 <> 0 THEN CAST(MonthlyIncome AS DOUBLE) END AS holed,
  CASE WHEN EmployeeNumber % 1001 = 0 THEN CAST('-inf' AS DOUBLE) WHEN EmployeeNumber % 9 <> 0 THEN CAST(MonthlyIncome AS DOUBLE) END AS endless
  FROM people)"""
_ODD_SQL = """
SELECT 'holed' AS feature, COUNT(holed) AS n, ROUND(AVG(holed), 8) AS mean, ROUND(STDDEV_SAMP(holed), 8) AS std, MIN(holed) AS min,
  quantile_cont(holed, 0.25) AS q25, quantile_cont(holed, 0.5) AS q50, quantile_cont(holed, 0.75) AS q75, MAX(holed) AS max, CAST(1 AS INT) AS position FROM odd
UNION ALL SELECT 'hollow', CAST(0 AS BIGINT), NULL, NULL, NULL, NULL, NULL, NULL, NULL, CAST(3 AS INT)
UNION ALL SELECT 'endless', COUNT(endless), CASE WHEN COUNT(*) FILTER (WHERE isinf(endless)) > 0 THEN CAST('-inf' AS DOUBLE) ELSE ROUND(AVG(endless), 8) END, CASE WHEN COUNT(*) FILTER (WHERE isinf(endless)) > 0 THEN NULL
    ELSE ROUND(SQRT((COUNT(endless) * SUM(f * f) - SUM(f) * SUM(f)) / (COUNT(endless) * (COUNT(endless) - 1.0::DOUBLE))), 8) END,
  MIN(endless), quantile_cont(endless, 0.25), quantile_cont(endless, 0.5), quantile_cont(endless, 0.75), MAX(endless), CAST(2 AS INT)
  FROM (SELECT endless, CASE WHEN isfinite(endless) THEN endless END AS f FROM odd)"""
add("describe_nan", over(lambda df: rounded(aggregate.describe(df, ["holed", "endless", "hollow"]), "mean", "std", places=8), odd_numbers),
    sql("people", _ODD_SQL, _ODD))
add("group_median_nan", over(lambda df: aggregate.center_by_class(df, "holed", "Attrition"), odd_numbers),
    sql("people", """SELECT Attrition, quantile_cont(holed, 0.5) AS median, AVG(holed) AS mean, COUNT(holed) AS n
    FROM odd GROUP BY 1""", _ODD))
add("box_stats_nan", over(lambda df: aggregate.box_stats(df, "holed", "Attrition"), odd_numbers), sql("people", """
SELECT p.Attrition, MIN(p.holed) AS min, MAX(p.holed) AS max, q.q1, q.median, q.q3,
  MIN(CASE WHEN p.holed BETWEEN q.lo AND q.hi THEN p.holed END) AS whisker_low,
  MAX(CASE WHEN p.holed BETWEEN q.lo AND q.hi THEN p.holed END) AS whisker_high,
  COUNT(*) FILTER (WHERE p.holed < q.lo OR p.holed > q.hi) AS outliers
FROM odd p JOIN fence q USING (Attrition) GROUP BY p.Attrition, q.q1, q.median, q.q3""", _ODD,
    """fence AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (
  SELECT Attrition, quantile_cont(holed, 0.25) AS q1, quantile_cont(holed, 0.5) AS median,
    quantile_cont(holed, 0.75) AS q3 FROM odd GROUP BY 1))"""))
add("violin_nan", over(lambda df: aggregate.violin_stats(df, "holed", "JobLevel"), odd_numbers), sql("people", """
SELECT JobLevel, COUNT(holed) AS n, AVG(holed) AS mean, quantile_cont(holed, 0.5) AS median,
  MIN(holed) AS min, MAX(holed) AS max FROM odd GROUP BY 1""", _ODD))

# --- histograms, box and violin --------------------------------------------------------------


def _histogram_sql(columns, by: str, bins: int, source: str = "people") -> list[str]:
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {by} AS k, CAST({c} AS DOUBLE) AS v FROM {source} "
        f"WHERE {c} IS NOT NULL AND {by} IS NOT NULL" for c in columns)
    return [
        f"long AS ({long})",
        "span AS (SELECT feature, k, COUNT(*) AS total, "
        "CASE WHEN MIN(v) = MAX(v) THEN MIN(v) - 0.5 ELSE MIN(v) END AS lo, "
        "CASE WHEN MIN(v) = MAX(v) THEN MAX(v) + 0.5 ELSE MAX(v) END AS hi FROM long GROUP BY 1, 2)",
        f"edges AS (SELECT *, (hi - lo) / {bins}.0::DOUBLE AS w, CAST(i AS INT) AS bin FROM span, range(0, {bins}) r(i))",
        f"bins AS (SELECT feature, k, total, bin, w, lo + bin * w AS bin_start, "
        f"CASE WHEN bin = {bins - 1} THEN hi ELSE lo + (bin + 1) * w END AS bin_end FROM edges)",
    ]


def _histogram_query(by: str, bins: int) -> str:
    return f"""
SELECT b.feature, b.k AS {by}, b.bin, b.bin_start, b.bin_end, COUNT(l.v) AS n, COUNT(l.v) / (b.total * b.w) AS density
FROM bins b LEFT JOIN long l ON l.feature = b.feature AND l.k = b.k AND l.v >= b.bin_start
  AND (l.v < b.bin_end OR (b.bin = {bins - 1} AND l.v <= b.bin_end))
GROUP BY b.feature, b.k, b.bin, b.bin_start, b.bin_end, b.total, b.w"""


add("histogram", over(lambda df: aggregate.histogram(df, NUMERIC, "Attrition", 30), raw),
    sql("people", _histogram_query("Attrition", 30), *_histogram_sql(NUMERIC, "Attrition", 30)))
add("histogram_density", over(lambda df: aggregate.histogram(df, specs.TENURE_COLUMNS, "Attrition", 20), raw),
    sql("people", _histogram_query("Attrition", 20), *_histogram_sql(specs.TENURE_COLUMNS, "Attrition", 20)))
_FINITE = """finite AS (SELECT Attrition, holed, CASE WHEN isfinite(endless) THEN endless END AS endless FROM odd)"""
add("histogram_nan", over(lambda df: aggregate.histogram(df, ["holed", "endless"], "Attrition", 30), odd_numbers),
    sql("people", _histogram_query("Attrition", 30), _ODD, _FINITE, *_histogram_sql(["holed", "endless"], "Attrition", 30, "finite")))
add("box_stats", over(lambda df: aggregate.box_stats(df, "MonthlyIncome", "Attrition"), raw), sql("people", """
SELECT p.Attrition, MIN(p.MonthlyIncome) AS min, MAX(p.MonthlyIncome) AS max, q.q1, q.median, q.q3,
  MIN(CASE WHEN p.MonthlyIncome BETWEEN q.lo AND q.hi THEN p.MonthlyIncome END) AS whisker_low,
  MAX(CASE WHEN p.MonthlyIncome BETWEEN q.lo AND q.hi THEN p.MonthlyIncome END) AS whisker_high,
  COUNT(*) FILTER (WHERE p.MonthlyIncome < q.lo OR p.MonthlyIncome > q.hi) AS outliers
FROM people p JOIN fence q USING (Attrition) GROUP BY p.Attrition, q.q1, q.median, q.q3""",
    """fence AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (
  SELECT Attrition, quantile_cont(MonthlyIncome, 0.25) AS q1, quantile_cont(MonthlyIncome, 0.5) AS median,
    quantile_cont(MonthlyIncome, 0.75) AS q3 FROM people GROUP BY 1))"""))


def box_lineitem(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return rounded(aggregate.box_stats(lines, "l_extendedprice", "l_returnflag"), "q1", "median", "q3")


add("box_stats_lineitem", box_lineitem, """
WITH fence AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (
  SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median,
    quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1))
SELECT p.l_returnflag, MIN(l_extendedprice) AS min, MAX(l_extendedprice) AS max,
  ROUND(q.q1, 6) AS q1, ROUND(q.median, 6) AS median, ROUND(q.q3, 6) AS q3,
  MIN(CASE WHEN l_extendedprice BETWEEN q.lo AND q.hi THEN l_extendedprice END) AS whisker_low,
  MAX(CASE WHEN l_extendedprice BETWEEN q.lo AND q.hi THEN l_extendedprice END) AS whisker_high,
  COUNT(*) FILTER (WHERE l_extendedprice < q.lo OR l_extendedprice > q.hi) AS outliers
FROM lineitem p JOIN fence q USING (l_returnflag) GROUP BY p.l_returnflag, q.q1, q.median, q.q3""")
add("violin_stats", over(lambda df: aggregate.violin_stats(df, "MonthlyIncome", "JobLevel"), raw), sql("people", """
SELECT JobLevel, COUNT(*) AS n, AVG(MonthlyIncome) AS mean, quantile_cont(MonthlyIncome, 0.5) AS median,
  MIN(MonthlyIncome) AS min, MAX(MonthlyIncome) AS max FROM people GROUP BY 1"""))
add("violin_density", over(lambda df: aggregate.histogram(df, ["MonthlyIncome"], "JobLevel", 20), raw),
    sql("people", _histogram_query("JobLevel", 20), *_histogram_sql(["MonthlyIncome"], "JobLevel", 20)))

# --- contingency, conditional counts, modes ----------------------------------------------------

add("crosstab", over(lambda df: aggregate.crosstab(df, "OverTime", "Attrition"), raw),
    sql("people", "SELECT OverTime, Attrition, COUNT(*) AS n FROM people GROUP BY 1, 2"))
add("crosstab_lineitem", lambda spark, sf_dir: aggregate.crosstab(
        table(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus"),
    "SELECT l_returnflag, l_linestatus, COUNT(*) AS n FROM lineitem GROUP BY 1, 2")
add("conditional_counts", over(lambda df: aggregate.conditional_counts(df, {
        "left_with_overtime": (F.col("attrition") == 1) & (F.col("overtime") == 1),
        "left_without_overtime": (F.col("attrition") == 1) & (F.col("overtime") == 0),
        "senior": F.col("job_level") >= 4}, by=["department"]), clean),
    sql("silver", """SELECT department, COUNT(*) FILTER (WHERE attrition = 1 AND overtime = 1) AS left_with_overtime,
    COUNT(*) FILTER (WHERE attrition = 1 AND overtime = 0) AS left_without_overtime,
    COUNT(*) FILTER (WHERE job_level >= 4) AS senior FROM silver GROUP BY 1"""))
_MODES = specs.RAW_COLUMNS
add("column_mode", over(lambda df: aggregate.column_modes(df, _MODES), raw), sql("people", " UNION ALL ".join(
    f"(SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS mode, COUNT(*) AS n FROM people GROUP BY {c} "
    f"ORDER BY COUNT(*) DESC, {c} LIMIT 1)" for c in _MODES)))

# --- sorts, limits, duplicates --------------------------------------------------------------------

add("sort_report", over(lambda df: topk.sort_report(
        aggregate.rates(df, CATEGORICAL, "Attrition_Flag"), F.col("rate").desc(), "feature", "level"), flagged),
    sql("people", _rates_sql(CATEGORICAL), _FL))
add("top_k", over(lambda df: topk.top_k(df, 15, F.col("monthly_income").desc(), F.col(KEY)).select(
        KEY, "monthly_income", "age_band"), labelled),
    sql("labelled", f"SELECT {KEY}, monthly_income, age_band FROM labelled ORDER BY monthly_income DESC, {KEY} LIMIT 15"))
add("top_k_lineitem", lambda spark, sf_dir: topk.top_k(
        table(spark, sf_dir, "lineitem"), 20, F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber", "l_partkey",
    ).select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"),
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
    ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 20""")
add("arg_max", over(lambda df: topk.arg_max(
        df.groupBy("job_role").agg(F.avg("attrition").alias("rate"), F.count(F.lit(1)).alias("n")), "rate", "job_role"), clean),
    sql("silver", """SELECT job_role, AVG(attrition) AS rate, COUNT(*) AS n FROM silver GROUP BY 1
    ORDER BY rate DESC, job_role LIMIT 1"""))
add("limit_rows", over(lambda df: aggregate.row_count(topk.preview(df)).select("n_rows"), raw),
    sql("people", "SELECT COUNT(*) AS n_rows FROM (SELECT * FROM people LIMIT 5)"))
add("duplicate_rows", over(aggregate.duplicate_rows, raw), sql("people", """
SELECT COALESCE(CAST(SUM(n - 1) AS BIGINT), 0) AS duplicates FROM (SELECT COUNT(*) AS n FROM people GROUP BY ALL)
""".replace("SELECT COUNT(*) AS n FROM people GROUP BY ALL",
            f"SELECT COUNT(*) AS n FROM people GROUP BY {', '.join(specs.RAW_COLUMNS)}")))
add("duplicate_rows_without_key", over(lambda df: aggregate.duplicate_rows(
        df, ["Department", "JobRole", "Age", "JobLevel", "MaritalStatus"]), raw), sql("people", """
SELECT CAST(SUM(n - 1) AS BIGINT) AS duplicates FROM (
  SELECT COUNT(*) AS n FROM people GROUP BY Department, JobRole, Age, JobLevel, MaritalStatus)"""))


def typed_events(spark, sf_dir):
    """Events cut down to months, with microseconds, zeros of both signs, NaN, nulls and nested cells."""
    events, key = table(spark, sf_dir, "events"), F.col("event_id")
    month = F.unix_micros(F.date_trunc("month", F.col("ts").cast("timestamp")))
    number = (
        F.when(key % 5 == 0, F.lit(0.0)).when(key % 5 == 1, F.lit(-0.0)).when(key % 5 == 2, F.lit(float("nan")))
        .when(key % 5 == 3, F.lit(None)).otherwise(F.floor(F.col("value") / 16).cast("double"))
    )
    return events.select(
        F.timestamp_micros(month + key % 3).alias("at"), number.alias("number"),
        F.struct("event_type", F.array(F.col("user_id") % 2, F.lit(None)).alias("users")).alias("who"),
        F.create_map(F.lit("n"), number).alias("map"),
    )


add("duplicate_rows_typed", over(aggregate.duplicate_rows, typed_events), """
SELECT (SELECT COUNT(*) FROM events) - COUNT(*) AS duplicates FROM (
  SELECT DISTINCT date_trunc('month', ts) AS month, event_id % 3 AS micros, event_type, user_id % 2 AS u,
    CASE WHEN event_id % 5 IN (0, 1) THEN 'zero' WHEN event_id % 5 = 2 THEN 'nan' WHEN event_id % 5 = 3 OR value IS NULL THEN 'null'
      WHEN FLOOR(value / 16) = 0 THEN 'zero' ELSE CAST(FLOOR(value / 16) AS VARCHAR) END AS number FROM events)""")
add("duplicate_keys", over(lambda df: aggregate.duplicate_rows(df, ["EmployeeNumber"]), raw), sql("people", """
SELECT CAST(SUM(n - 1) AS BIGINT) AS duplicates FROM (SELECT COUNT(*) AS n FROM people GROUP BY EmployeeNumber)"""))
add("duplicate_keys_lineitem", lambda spark, sf_dir: aggregate.duplicate_rows(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]), """
SELECT CAST(SUM(n - 1) AS BIGINT) AS duplicates FROM (
  SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
