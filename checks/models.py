"""Splits, scaling, weights, training, evaluation and runs."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks.common import CARDS, all_cards, feature_rows, new_lake, over, rounded, sql
from tenura import specs
from tenura.operators import ranking
from tenura.operators.columns import fill_nulls
from tenura.plans import scoring, training
from tenura.session import scratch_path

QUERIES: dict = {}
ORACLE: dict = {}


def add(name, query, text=None):
    QUERIES[name] = query
    if text is not None:
        ORACLE[name] = text


KEY = specs.KEY
_SHARE = 0.20
_HASH = f"(({KEY} * {KEY} * 8837 + {KEY} * 31013 + 42) % {training.HASH_MODULUS})"
_SPLIT = f"""split AS (SELECT *, CASE WHEN place <= ROUND({_SHARE} * n) THEN 'test' ELSE 'train' END AS split FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY attrition ORDER BY {_HASH}, {KEY}) AS place,
    COUNT(*) OVER (PARTITION BY attrition) AS n FROM features))"""

# --- preparing ---------------------------------------------------------------------


def assemble_features(spark, sf_dir):
    """Vector of all 77 features per row, shown by its size and sum."""
    rows = feature_rows(spark, sf_dir)
    names = training.feature_names(rows, [KEY])
    filled = fill_nulls(rows, names)
    vectors = VectorAssembler(inputCols=names, outputCol="v", handleInvalid="error").transform(filled)
    values = vector_to_array("v")
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return vectors.select(KEY, F.size(values).cast("bigint").alias("n_features"), F.round(total, 4).alias("total"))


add("assemble_features", assemble_features, sql(
    "features", f"SELECT {KEY}, CAST(77 AS BIGINT) AS n_features, ROUND(" + " + ".join(
        f"COALESCE(CAST({c} AS DOUBLE), 0)" for c in specs.FEATURE_COLUMNS) + ", 4) AS total FROM features"))


def split_rows(spark, sf_dir):
    return training.stratified_split(feature_rows(spark, sf_dir), KEY, "attrition", _SHARE)


add("stratified_split", over(lambda df: df.select(KEY, "attrition", "split"), split_rows),
    sql("features", f"SELECT {KEY}, attrition, split FROM split", _SPLIT))
add("hash_split", over(lambda df: training.split_by_hash(df, KEY, _SHARE).select(KEY, "split"), feature_rows),
    sql("features", f"""SELECT {KEY}, CASE WHEN {_HASH} < {int(_SHARE * training.HASH_MODULUS)}
    THEN 'test' ELSE 'train' END AS split FROM features"""))
add("folds", over(lambda df: training.with_folds(df, KEY).groupBy("attrition", "fold").agg(F.count(F.lit(1)).alias("n")), feature_rows),
    sql("features", f"""SELECT attrition, fold, COUNT(*) AS n FROM (
  SELECT attrition, CAST((ROW_NUMBER() OVER (PARTITION BY attrition
    ORDER BY ({KEY} * {KEY} * 5417 + {KEY} * 31013 + 42) % 1000003, {KEY}) - 1) % 5 AS INT) AS fold FROM features)
GROUP BY 1, 2"""))
_SCALED = [c for c in specs.FEATURE_COLUMNS if c != "attrition"]


def standard_scale(spark, sf_dir):
    """Scaling fitted on the train rows only, applied to all."""
    rows = split_rows(spark, sf_dir).select(KEY, "split", *_SCALED)
    scaling = training.fit_scaling(rows.filter("split = 'train'"), _SCALED)
    return rounded(training.apply_scaling(rows, scaling), *_SCALED)


add("standard_scale", standard_scale, sql("features", f"SELECT {KEY}, split, " + ", ".join(
    f"ROUND(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in _SCALED) + " FROM split, params", _SPLIT,
    "params AS (SELECT " + ", ".join(
        f"AVG(CAST({c} AS DOUBLE)) AS m_{c}, STDDEV_POP(CAST({c} AS DOUBLE)) AS s_{c}" for c in _SCALED)
    + " FROM split WHERE split = 'train')"))


def scaled_report(spark, sf_dir):
    """Mean and deviation per column after scaling: 0 and 1 on the train rows."""
    rows = split_rows(spark, sf_dir).filter("split = 'train'").select(*_SCALED)
    scaled = training.apply_scaling(rows, training.fit_scaling(rows, _SCALED))
    stats = scaled.agg(
        *[F.abs(F.round(F.avg(c), 6)).alias(f"mean_{c}") for c in _SCALED],
        *[F.round(F.stddev_pop(c), 6).alias(f"std_{c}") for c in _SCALED],
    )
    return stats.withColumn("n", F.lit(rows.count()).cast("bigint"))


add("scaled_report", scaled_report, sql("features", "SELECT " + ", ".join(
    f"0.0::DOUBLE AS mean_{c}, 1.0::DOUBLE AS std_{c}" for c in _SCALED)
    + ", COUNT(*) AS n FROM split WHERE split = 'train'", _SPLIT))
add("class_weights", over(lambda df: training.with_class_weights(df).groupBy("attrition").agg(
        F.count(F.lit(1)).alias("n"), F.max("weight").alias("weight"), F.round(F.sum("weight"), 6).alias("total")), feature_rows),
    sql("features", """SELECT attrition, COUNT(*) AS n,
    (SELECT COUNT(*) FROM features) / (2.0::DOUBLE * COUNT(*)) AS weight,
    ROUND((SELECT COUNT(*) FROM features) / 2.0::DOUBLE, 6) AS total FROM features GROUP BY 1"""))

# --- training ------------------------------------------------------------------------


def _train(spark, sf_dir, spec):
    rows = split_rows(spark, sf_dir)
    names = training.feature_names(rows, [KEY])
    rows = fill_nulls(rows, names).cache()
    model = training.fit_model(rows.filter("split = 'train'"), spec, names)
    return rows, names, model


def _trained(spec):
    def query(spark, sf_dir):
        rows, names, model = _train(spark, sf_dir, spec)
        scored = training.score(model, rows, names, keep=["attrition", "split"])
        return ranking.binary_metrics(scored, "probability", "attrition", "prediction", by=["split"])
    return query


add("train_logistic", _trained(training.LOGISTIC))
add("train_random_forest", _trained(training.FOREST))
add("train_gbt", _trained(training.BOOSTED))


def cross_validate(spark, sf_dir):
    rows = split_rows(spark, sf_dir)
    names = training.feature_names(rows, [KEY])
    train = fill_nulls(rows, names).filter("split = 'train'")  # the split has written the rows
    return training.cross_validate(train, training.LOGISTIC, names, KEY)


add("cross_validate", cross_validate)


def _importance(spec):
    def query(spark, sf_dir):
        _, names, model = _train(spark, sf_dir, spec)
        return training.feature_importance(model, names, spark)
    return query


def lr_coefficients(spark, sf_dir):
    _, names, model = _train(spark, sf_dir, training.LOGISTIC)
    table = training.coefficients(model, names, spark)
    return table.orderBy(F.col("abs_coefficient").desc(), "feature").limit(20)


def lr_drivers(spark, sf_dir):
    _, names, model = _train(spark, sf_dir, training.LOGISTIC)
    return training.drivers(training.coefficients(model, names, spark))


add("feature_importance", _importance(training.FOREST))
add("feature_importance_boosted", _importance(training.BOOSTED))
add("lr_coefficients", lr_coefficients)
add("lr_drivers", lr_drivers)

# --- evaluation on the fixed score cards -------------------------------------------------

_COUNTS = """counts AS (SELECT model, COUNT(*) FILTER (WHERE attrition = 1 AND prediction = 1) AS tp,
  COUNT(*) FILTER (WHERE attrition = 0 AND prediction = 1) AS fp,
  COUNT(*) FILTER (WHERE attrition = 1 AND prediction = 0) AS fn,
  COUNT(*) FILTER (WHERE attrition = 0 AND prediction = 0) AS tn FROM cards GROUP BY model)"""
_AUC = """auc AS (SELECT model, (r1 - n1 * (n1 + 1) / 2) / (n1 * n2) AS auc_roc FROM (
  SELECT model, SUM(attrition)::DOUBLE AS n1, (COUNT(*) - SUM(attrition))::DOUBLE AS n2,
    SUM(CASE WHEN attrition = 1 THEN place END)::DOUBLE AS r1 FROM (
    SELECT model, attrition, RANK() OVER (PARTITION BY model ORDER BY score)
      + (COUNT(*) OVER (PARTITION BY model, score) - 1) / 2.0 AS place FROM cards) GROUP BY model))"""
_STEPS = """steps AS (SELECT model, score, pos, neg,
  CAST(SUM(pos) OVER w AS BIGINT) AS tp, CAST(SUM(neg) OVER w AS BIGINT) AS fp,
  CAST(SUM(pos) OVER (PARTITION BY model) AS BIGINT) AS n_pos, CAST(SUM(neg) OVER (PARTITION BY model) AS BIGINT) AS n_neg
  FROM (SELECT model, score, SUM(attrition) AS pos, SUM(1 - attrition) AS neg FROM cards GROUP BY 1, 2)
  WINDOW w AS (PARTITION BY model ORDER BY score DESC))"""
_AP = """ap AS (SELECT model, SUM(pos * (tp::DOUBLE / (tp + fp))) / MAX(n_pos) AS avg_precision FROM steps GROUP BY model)"""
_METRICS = """metrics AS (SELECT model,
  (tp + tn)::DOUBLE / (tp + fp + fn + tn) AS accuracy,
  CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0 END AS recall,
  CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0::DOUBLE * tp / (2 * tp + fp + fn) ELSE 0 END AS f1,
  ROUND(auc_roc, 9) AS auc_roc, ROUND(avg_precision, 9) AS avg_precision
  FROM counts JOIN auc USING (model) JOIN ap USING (model))"""
_EVAL = [_COUNTS, _AUC, _STEPS, _AP, _METRICS]


def card_metrics(spark, sf_dir):
    rows = all_cards(spark, sf_dir)
    metrics = ranking.binary_metrics(rows, "score", "attrition", "prediction", by=["model"])
    return rounded(metrics, "auc_roc", "avg_precision", places=9)


add("binary_metrics", card_metrics, sql("cards", "SELECT * FROM metrics", *_EVAL))
_ALL_POINTS = """SELECT model, score AS threshold, fp::DOUBLE / n_neg AS fpr, tp::DOUBLE / n_pos AS tpr FROM steps
    UNION ALL SELECT DISTINCT model, 'inf'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM cards"""
add("roc_curve", over(lambda df: ranking.roc_curve(df, "score", "attrition", by=["model"]), all_cards), sql("cards", _ALL_POINTS, _STEPS))
add("roc_curve_all_points", over(lambda df: ranking.roc_curve(df, "score", "attrition", by=["model"], drop_collinear=False), all_cards),
    sql("cards", _ALL_POINTS, _STEPS))
add("roc_curve_corners", over(lambda df: ranking.roc_curve(df, "score", "attrition", by=["model"], drop_collinear=True), all_cards),
    sql("cards", """SELECT model, score AS threshold, fp::DOUBLE / n_neg AS fpr, tp::DOUBLE / n_pos AS tpr FROM (
      SELECT *, LAG(tp) OVER w AS tp0, LAG(fp) OVER w AS fp0, LEAD(tp) OVER w AS tp2, LEAD(fp) OVER w AS fp2 FROM steps
      WINDOW w AS (PARTITION BY model ORDER BY score DESC))
    WHERE tp0 IS NULL OR tp2 IS NULL OR (tp - tp0) * (fp2 - fp) <> (tp2 - tp) * (fp - fp0)
    UNION ALL SELECT DISTINCT model, 'inf'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM cards""", _STEPS))
add("pr_curve", over(lambda df: ranking.pr_curve(df, "score", "attrition", by=["model"]), all_cards),
    sql("cards", """SELECT model, score AS threshold, tp::DOUBLE / (tp + fp) AS precision, tp::DOUBLE / n_pos AS recall,
    n_pos::DOUBLE / (n_pos + n_neg) AS base_rate FROM steps
    UNION ALL SELECT model, 'inf'::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE, SUM(attrition)::DOUBLE / COUNT(*) FROM cards GROUP BY model""", _STEPS))
add("confusion_matrix", over(lambda df: ranking.confusion_matrix(df, "attrition", "prediction", by=["model"]), all_cards),
    sql("cards", """SELECT m.model, CAST(a AS INT) AS actual, CAST(p AS INT) AS predicted, COUNT(c.attrition) AS n
    FROM (SELECT DISTINCT model FROM cards) m CROSS JOIN range(0, 2) x(a) CROSS JOIN range(0, 2) y(p)
    LEFT JOIN cards c ON c.attrition = a AND c.prediction = p AND c.model = m.model GROUP BY 1, 2, 3"""))
_REPORT = """
one AS (SELECT model, 'Stayed' AS label, tn AS hit, fn AS wrong, fp AS missed FROM counts
  UNION ALL SELECT model, 'Left', tp, fp, fn FROM counts),
lines AS (SELECT model, label, CASE WHEN hit + wrong > 0 THEN hit::DOUBLE / (hit + wrong) ELSE 0 END AS precision,
  CASE WHEN hit + missed > 0 THEN hit::DOUBLE / (hit + missed) ELSE 0 END AS recall,
  CASE WHEN 2 * hit + wrong + missed > 0 THEN 2.0::DOUBLE * hit / (2 * hit + wrong + missed) ELSE 0 END AS f1,
  hit + missed AS support FROM one),
acc AS (SELECT model, (tp + tn)::DOUBLE / (tp + fp + fn + tn) AS a, tp + fp + fn + tn AS n FROM counts),
report AS (SELECT * FROM lines
  UNION ALL SELECT model, 'accuracy', a, a, a, n FROM acc
  UNION ALL SELECT model, 'macro avg', AVG(precision), AVG(recall), AVG(f1), CAST(SUM(support) AS BIGINT) FROM lines GROUP BY model
  UNION ALL SELECT model, 'weighted avg', SUM(precision * support) / SUM(support), SUM(recall * support) / SUM(support),
    SUM(f1 * support) / SUM(support), CAST(SUM(support) AS BIGINT) FROM lines GROUP BY model)"""
add("classification_report", over(lambda df: rounded(
        ranking.classification_report(df, "attrition", "prediction", by=["model"]), "precision", "recall", "f1", places=9), all_cards),
    sql("cards", "SELECT model, label, ROUND(precision, 9) AS precision, ROUND(recall, 9) AS recall, ROUND(f1, 9) AS f1, support FROM report",
        _COUNTS, _REPORT.strip()))

# --- runs -------------------------------------------------------------------------------------


def _logged(spark, sf_dir, mark_best: bool = True):
    """One run per card, and a marked copy of the best, in a run table of their own."""
    lake = new_lake(spark)
    metrics = {row["model"]: row.asDict() for row in card_metrics(spark, sf_dir).collect()}  # one row per model
    for name, (weights, intercept) in CARDS.items():
        values = {k: v for k, v in metrics[name].items() if k != "model"}
        training.log_run(lake, name, {"intercept": intercept, **weights}, values, features=list(weights))
    if mark_best:
        best = max(CARDS, key=lambda name: metrics[name]["auc_roc"])
        values = {k: metrics[best][k] for k in training.BEST_METRICS if k in metrics[best]}
        training.log_run(lake, f"BEST_{best}", {"is_best": True}, values, features=list(CARDS[best][0]))
    return lake.read("gold.ml_runs")


def log_run(spark, sf_dir):
    return _logged(spark, sf_dir).select(
        "run_name", F.size("features").alias("n_features"), F.size("params").alias("n_params"),
        F.size("metrics").alias("n_metrics"), F.col("metrics")["auc_roc"].alias("auc_roc"),
        F.col("started_at").isNotNull().alias("stamped"))


_SIZES = ", ".join(f"('{name}', {len(w)})" for name, (w, _) in CARDS.items())
add("log_run", log_run, sql("cards", f"""
SELECT model AS run_name, CAST(k AS INT) AS n_features, CAST(k + 1 AS INT) AS n_params, 6 AS n_metrics, auc_roc, TRUE AS stamped
  FROM metrics JOIN (VALUES {_SIZES}) s(model, k) USING (model)
UNION ALL (SELECT 'BEST_' || model, CAST(k AS INT), 1, 4, auc_roc, TRUE
  FROM metrics JOIN (VALUES {_SIZES}) s(model, k) USING (model) ORDER BY auc_roc DESC LIMIT 1)""", *_EVAL))
add("model_comparison", lambda spark, sf_dir: training.model_comparison(_logged(spark, sf_dir, False)), sql("cards", """
SELECT model, auc_roc, f1, precision, recall, accuracy, CAST(NULL AS DOUBLE) AS cv_auc_mean,
  CAST(NULL AS DOUBLE) AS cv_auc_std, avg_precision FROM metrics ORDER BY auc_roc DESC""", *_EVAL))


def select_best_run(spark, sf_dir):
    """The marked run where there is one, and the fallback to the best of all."""
    runs = _logged(spark, sf_dir)
    marked = training.select_best_run(runs).select(F.lit("marked").alias("choice"), "run_name", F.col("metrics")["auc_roc"].alias("auc_roc"))
    plain = training.select_best_run(runs.filter(~F.col("run_name").startswith("BEST_")))
    return marked.unionByName(plain.select(F.lit("fallback").alias("choice"), "run_name", F.col("metrics")["auc_roc"].alias("auc_roc")))


add("select_best_run", select_best_run, sql("cards", """
(SELECT 'marked' AS choice, 'BEST_' || model AS run_name, auc_roc FROM metrics ORDER BY auc_roc DESC LIMIT 1)
UNION ALL (SELECT 'fallback', model, auc_roc FROM metrics ORDER BY auc_roc DESC LIMIT 1)""", *_EVAL))
add("auc_sanity", over(training.auc_sanity, card_metrics), sql("cards", """
SELECT MIN(auc_roc) AS lowest, MAX(auc_roc) AS highest, CASE WHEN MIN(auc_roc) > 0.60 THEN 'signal'
  WHEN MAX(auc_roc) < 0.55 THEN 'no signal' ELSE 'mixed' END AS verdict, MAX(auc_roc) > 0.95 AS leakage_warning FROM metrics""", *_EVAL))


def training_summary(spark, sf_dir):
    return training.training_summary(split_rows(spark, sf_dir), specs.FEATURE_COLUMNS, _logged(spark, sf_dir))


add("training_summary", training_summary, sql("cards", """
SELECT COUNT(*) AS n_rows, 77 AS n_features, AVG(attrition) * 100 AS attrition_pct,
  COUNT(*) FILTER (WHERE split = 'train') AS n_train, COUNT(*) FILTER (WHERE split = 'test') AS n_test,
  (SELECT 'BEST_' || model FROM metrics ORDER BY auc_roc DESC LIMIT 1) AS best_run,
  (SELECT MAX(auc_roc) FROM metrics) AS best_auc FROM split""", *_EVAL, _SPLIT))

# --- scoring with a saved model -------------------------------------------------------------------


def batch_score(spark, sf_dir):
    """Train, save, log, look the best run up again, load it and score everyone."""
    lake = new_lake(spark)
    rows = feature_rows(spark, sf_dir)
    training.train_all(lake, rows, KEY, [training.LOGISTIC], folds=0, model_root=scratch_path(spark, "models"))
    return scoring.batch_score(rows, lake.read("gold.ml_runs")).select(KEY, "attrition", "probability", "prediction")


add("batch_score", batch_score)
