"""Scoring, risk reports and the data behind the dashboard."""

from __future__ import annotations

from checks.aggregates import _histogram_query, _histogram_sql
from checks.common import labelled, over, risk_rows, rounded, scored, sql
from tenura import specs
from tenura.plans import boards, scoring

QUERIES: dict = {}
ORACLE: dict = {}


def add(name, query, text=None):
    QUERIES[name] = query
    if text is not None:
        ORACLE[name] = text


KEY = specs.KEY
P = "attrition_probability"

add("score_linear", over(lambda df: rounded(df.select(KEY, "probability", "prediction"), "probability", places=9), scored),
    sql("risk", f"SELECT {KEY}, ROUND(probability, 9) AS probability, predicted_attrition AS prediction FROM risk"))


def predictions(spark, sf_dir):
    return scoring.predictions(scored(spark, sf_dir))


add("predictions_table", predictions, sql("predictions", "SELECT * FROM predictions"))
add("score_summary", over(lambda df: rounded(scoring.score_summary(df), "mean_probability"), risk_rows), sql("risk", f"""
SELECT COUNT(*) AS n, MIN({P}) AS min_probability, MAX({P}) AS max_probability, ROUND(AVG({P}), 6) AS mean_probability,
  CAST(SUM(predicted_attrition) AS BIGINT) AS predicted_positive FROM risk"""))
_TIERS = "tiers AS (SELECT * FROM (VALUES (1, 'High'), (2, 'Medium'), (3, 'Low')) t(position, risk_tier))"
_DISTRIBUTION = """SELECT position, t.risk_tier, COUNT(r.attrition) AS n,
  COUNT(r.attrition) * 100.0::DOUBLE / (SELECT COUNT(*) FROM risk) AS pct
FROM tiers t LEFT JOIN risk r ON r.risk_tier = t.risk_tier GROUP BY 1, 2"""
add("tier_distribution", over(scoring.tier_distribution, risk_rows), sql("risk", _DISTRIBUTION, _TIERS))
add("tier_distribution_empty_tier", lambda spark, sf_dir: scoring.tier_distribution(risk_rows(spark, sf_dir, "Income Card")
        ).select("position", "risk_tier", "n"),
    sql("cards", """SELECT position, t.risk_tier, COUNT(r.attrition) AS n FROM tiers t LEFT JOIN (
  SELECT attrition, CASE WHEN score <= 0.30 THEN 'Low' WHEN score <= 0.60 THEN 'Medium' ELSE 'High' END AS risk_tier
  FROM cards WHERE model = 'Income Card') r ON r.risk_tier = t.risk_tier GROUP BY 1, 2""", _TIERS))
add("risk_by_department", over(lambda df: rounded(scoring.risk_by_department(df), "avg_risk"), risk_rows), sql("risk", f"""
SELECT department_name, ROUND(AVG({P}), 6) AS avg_risk, COUNT(*) FILTER (WHERE risk_tier = 'High') AS high_risk_count,
  COUNT(*) AS headcount FROM risk GROUP BY 1 ORDER BY avg_risk DESC"""))
add("risk_by_role_top5", over(lambda df: rounded(scoring.risk_by_role(df), "avg_risk"), risk_rows), sql("risk", f"""
SELECT job_role_name, ROUND(AVG({P}), 6) AS avg_risk FROM risk GROUP BY 1 ORDER BY AVG({P}) DESC, job_role_name LIMIT 5"""))
_TOP = f"""SELECT employee_key, risk_tier, {P}, department_name, job_role_name, age, monthly_income,
  CASE WHEN attrition = 1 THEN 'LEFT' ELSE 'stayed' END AS outcome
FROM predictions ORDER BY {P} DESC, employee_key LIMIT 15"""
add("top_risk_people", over(scoring.top_risk, predictions), sql("predictions", _TOP))
add("score_validation", over(scoring.score_validation, risk_rows), sql("risk", """
SELECT tp, fp, fn, tn, tp + fn AS actual_positive, tp + fp AS predicted_positive,
  CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0 END AS recall,
  CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0 END AS precision FROM (
  SELECT COUNT(*) FILTER (WHERE attrition = 1 AND predicted_attrition = 1) AS tp,
    COUNT(*) FILTER (WHERE attrition = 0 AND predicted_attrition = 1) AS fp,
    COUNT(*) FILTER (WHERE attrition = 1 AND predicted_attrition = 0) AS fn,
    COUNT(*) FILTER (WHERE attrition = 0 AND predicted_attrition = 0) AS tn FROM risk)"""))
add("tier_vs_actual", over(lambda df: rounded(scoring.tier_vs_actual(df), "avg_probability"), risk_rows), sql("risk", f"""
SELECT risk_tier, COUNT(*) AS total, CAST(SUM(attrition) AS BIGINT) AS actual_left, ROUND(AVG({P}), 6) AS avg_probability,
  AVG(attrition) AS actual_rate FROM risk GROUP BY 1"""))

# --- dashboard data ------------------------------------------------------------------------

_RATE = "COUNT(*) AS n, CAST(SUM(attrition) AS BIGINT) AS left, AVG(attrition) * 100 AS attrition_rate"
_RATE = _RATE.replace("AS left", 'AS "left"')


def _rate_sql(column: str) -> str:
    return f"SELECT {column}, {_RATE} FROM labelled GROUP BY 1"


def _rates_sql(columns: dict) -> str:
    return " UNION ALL ".join(
        f"SELECT '{title}' AS dimension, CAST({c} AS VARCHAR) AS value, {_RATE} FROM labelled GROUP BY 2"
        for title, c in columns.items())


add("kpi_cards", over(boards.kpi_cards, labelled), sql("labelled", """
SELECT COUNT(*) AS total_employees, AVG(attrition) * 100 AS attrition_rate, AVG(monthly_income) AS avg_income,
  AVG(years_at_company) AS avg_tenure FROM labelled"""))
add("bi_attrition_dept_age", over(boards.by_department_and_age, labelled),
    sql("labelled", _rates_sql({"Department": "department", "Age Band": "age_band"})))
add("bi_gender_distribution", over(boards.gender_distribution, labelled), sql("labelled", """
SELECT gender_label, COUNT(*) AS n, COUNT(*) * 100.0::DOUBLE / (SELECT COUNT(*) FROM labelled) AS pct FROM labelled GROUP BY 1"""))
add("bi_overtime_impact", over(boards.overtime_impact, labelled), sql("labelled", _rate_sql("overtime_label")))
add("bi_satisfaction_heatmap", over(boards.satisfaction_heatmap, labelled), sql("labelled", " UNION ALL ".join(
    f"SELECT '{s}' AS scale, {s} AS level, {_RATE} FROM labelled GROUP BY 2" for s in boards.SATISFACTION_SCALES)))
add("bi_overtime_multiplier", over(boards.overtime_multiplier, labelled), sql("labelled", """
SELECT a AS rate_overtime, b AS rate_regular, a / b AS multiplier FROM (
  SELECT AVG(CASE WHEN overtime = 1 THEN attrition END) AS a, AVG(CASE WHEN overtime = 0 THEN attrition END) AS b FROM labelled)"""))
add("bi_travel_marital", over(boards.travel_and_marital, labelled),
    sql("labelled", _rates_sql({"Business Travel": "business_travel", "Marital Status": "marital_status"})))
add("bi_tenure_curve", over(boards.tenure_curve, labelled), sql("labelled", _rate_sql("years_at_company")))
add("bi_income_distribution", over(boards.income_distribution, labelled), sql(
    "labelled", _histogram_query("attrition_label", 30),
    *_histogram_sql(["monthly_income"], "attrition_label", 30, "labelled")))
add("bi_income_gap", over(boards.income_gap, labelled), sql("labelled", """
SELECT s.m AS median_stayed, l.m AS median_left, s.m - l.m AS median_gap, s.a AS mean_stayed, l.a AS mean_left, s.a - l.a AS mean_gap
FROM (SELECT quantile_cont(monthly_income, 0.5) AS m, AVG(monthly_income) AS a FROM labelled WHERE attrition = 0) s,
     (SELECT quantile_cont(monthly_income, 0.5) AS m, AVG(monthly_income) AS a FROM labelled WHERE attrition = 1) l"""))
add("bi_salary_hike", over(boards.salary_hike, labelled), sql("labelled", _rate_sql("percent_salary_hike")))
add("bi_stock_impact", over(boards.stock_impact, labelled), sql("labelled", _rate_sql("stock_option_level")))
add("bi_experience_income", over(boards.experience_income, labelled), sql("labelled", """
SELECT CAST(total_working_years // 5 * 5 AS BIGINT) AS x_bin, CAST(monthly_income // 1000 * 1000 AS BIGINT) AS y_bin,
  COUNT(*) AS n, AVG(attrition) AS rate FROM labelled GROUP BY 1, 2"""))
add("bi_risk_tiers", over(lambda df: rounded(boards.risk_tiers(df), "avg_probability"), risk_rows), sql("risk", f"""
SELECT department_name, risk_tier, COUNT(*) AS n, ROUND(AVG({P}), 6) AS avg_probability FROM risk GROUP BY 1, 2"""))
add("bi_probability_income", over(boards.probability_income, risk_rows), sql("risk", f"""
SELECT CAST(FLOOR({P} * 100 / 5) * 5 AS BIGINT) AS x_bin, CAST(monthly_income // 1000 * 1000 AS BIGINT) AS y_bin,
  COUNT(*) AS n, AVG(attrition) AS rate FROM risk GROUP BY 1, 2"""))
