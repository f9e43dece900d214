"""Splitting, weighting, fitting and comparing classifiers on the feature table."""

from __future__ import annotations

import math
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura import specs
from tenura.operators.columns import fill_nulls, numeric_columns
from tenura.operators.ordering import running_totals
from tenura.operators.ranking import binary_metrics, ranking_metrics
from tenura.operators.topk import top_k
from tenura.session import settle, shared_dir

SEED = 42
HASH_MODULUS = 1_000_003
LABEL, WEIGHT, SPLIT, FOLD = "attrition", "weight", "split", "fold"


# --- features and splits -------------------------------------------------------

def feature_names(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns except the target and the excluded ones."""
    return numeric_columns(df, [LABEL, WEIGHT, *exclude])


def key_hash(key: str, seed: int = SEED, salt: int = 8837) -> Column:
    """Integer in [0, HASH_MODULUS) from an integer key: the same wherever a row is."""
    k = F.pmod(F.col(key), F.lit(HASH_MODULUS))
    return F.pmod(k * k * salt + k * 31013 + seed, F.lit(HASH_MODULUS))


def split_by_hash(df: DataFrame, key: str, test_share: float, seed: int = SEED) -> DataFrame:
    """Train/test by key hash: shares hold per class on average; no shuffle at all."""
    bound = int(test_share * HASH_MODULUS)
    return df.withColumn(SPLIT, F.when(key_hash(key, seed) < bound, "test").otherwise("train"))


def stratified_split(df: DataFrame, key: str, label: str, test_share: float, seed: int = SEED) -> DataFrame:
    """Train/test with exactly ``round(share x n)`` test rows in every class.

    Test rows are a class's first ones by (hash, key). Only the cut-off per class
    is looked for: from counts per hash value, of which there are at most
    ``HASH_MODULUS``, then among the rows on the cut-off value itself. The rows are written
    first, so that what made them runs once; the passes read three narrow columns.
    """
    df = settle(df)
    hashed = df.select(label, key, key_hash(key, seed).alias("_h"))
    per_hash = hashed.groupBy(label, "_h").agg(F.count(F.lit(1)).alias("_n"))
    placed = running_totals(per_hash, ["_n"], ["_h"], within=[label]).select(
        label, "_h", "_n", F.col("_n_before").alias("_before"),
        F.round(F.lit(test_share) * F.col("_n_total")).cast("bigint").alias("_want"),
    )
    # one row per class: the hash value in which the last test row falls
    edge = placed.filter(
        (F.col("_before") < F.col("_want")) & (F.col("_want") <= F.col("_before") + F.col("_n"))
    ).select(F.col(label).alias("_class"), F.col("_h").alias("_edge"), (F.col("_want") - F.col("_before")).alias("_rest"))
    on_edge = hashed.join(
        F.broadcast(edge), (F.col(label) == F.col("_class")) & (F.col("_h") == F.col("_edge"))
    )
    # badly spread keys may share that hash value in any number: ranked in blocks
    on_edge = on_edge.groupBy("_class", "_edge", "_rest", key).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_totals(on_edge, ["_n"], [key], within=["_class"])
    cuts = (
        ranked.filter(
            (F.col("_n_before") < F.col("_rest")) & (F.col("_rest") <= F.col("_n_before") + F.col("_n"))
        )
        .select("_class", "_edge", F.col(key).alias("_last"))
        .collect()  # one row per class
    )
    test = F.lit(False)
    for cut in cuts:
        inside = (F.col("_h") < cut["_edge"]) | ((F.col("_h") == cut["_edge"]) & (F.col(key) <= cut["_last"]))
        test = test | ((F.col(label) == F.lit(cut["_class"])) & inside)
    return (
        df.withColumn("_h", key_hash(key, seed))
        .withColumn(SPLIT, F.when(test, "test").otherwise("train"))
        .drop("_h")
    )


def with_folds(df: DataFrame, key: str, folds: int = 5, seed: int = SEED, label: str = LABEL) -> DataFrame:
    """Stratified folds: a class's rows in the order of (hash, key) are dealt out in turn.

    With unique keys the folds of a class differ by one row at most; rows that share a
    key share a fold. Ranks come from block totals, so no class is one task's work.
    """
    counts = df.groupBy(F.col(label).alias("_label"), F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_h", key_hash("_key", seed, salt=5417))
    ranked = running_totals(counts, ["_n"], ["_h", "_key"], within=["_label"])
    dealt = ranked.select("_label", "_key", F.pmod(F.col("_n_before"), F.lit(folds)).cast("int").alias(FOLD))
    mine = df[key].eqNullSafe(dealt["_key"]) & df[label].eqNullSafe(dealt["_label"])
    return df.join(dealt, mine, "left").drop("_label", "_key")


def class_counts(df: DataFrame, label: str = LABEL) -> dict[int, int]:
    """Rows per class of a 0/1 label; anything else raises before it is collected."""
    other = df.filter(~F.coalesce(F.col(label).isin(0, 1), F.lit(False))).select(label).head(1)
    if other:
        raise ValueError(f"{label} must be 0 or 1, not {other[0][0]}")
    return {r[0]: r[1] for r in df.groupBy(label).agg(F.count(F.lit(1))).collect()}


def with_class_weights(df: DataFrame, label: str = LABEL, counts: Mapping[int, int] | None = None) -> DataFrame:
    """Balanced weight ``n / (classes x n_class)`` per row."""
    counts = counts or class_counts(df, label)
    total, weight = sum(counts.values()), F.lit(None).cast("double")
    for value, n in counts.items():
        weight = F.when(F.col(label) == value, total / (len(counts) * n)).otherwise(weight)
    return df.withColumn(WEIGHT, weight)


# --- scaling ---------------------------------------------------------------------

def fit_scaling(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column: one pass, one row back."""
    row = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    ).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in columns}


def apply_scaling(df: DataFrame, scaling: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Zero mean, unit deviation; a constant column is only centred."""
    return df.withColumns(
        {c: (F.col(c) - F.lit(m)) / F.lit(s if s else 1.0) for c, (m, s) in scaling.items()}
    )


# --- models ------------------------------------------------------------------------

@dataclass(frozen=True)
class ModelSpec:
    """A classifier to fit. The reference settings of the three models."""

    name: str
    kind: str
    scaled: bool
    balanced: bool
    params: Mapping[str, object] = field(default_factory=dict)


LOGISTIC = ModelSpec("Logistic Regression", "logistic", scaled=True, balanced=True,
                     params={"C": 0.1, "maxIter": 1000})
FOREST = ModelSpec("Random Forest", "forest", scaled=False, balanced=True,
                   params={"numTrees": 300, "maxDepth": 10, "minInstancesPerNode": 5})
BOOSTED = ModelSpec("Gradient Boosted Trees", "boosted", scaled=False, balanced=False,
                    params={"maxIter": 200, "maxDepth": 5, "stepSize": 0.1,
                            "subsamplingRate": 0.8, "minInstancesPerNode": 5})
MODELS = (FOREST, LOGISTIC, BOOSTED)


def _classifier(spec: ModelSpec, features: str, weight_total: float):
    params = dict(spec.params)
    common = {"labelCol": LABEL, "featuresCol": features}
    if spec.balanced:
        common["weightCol"] = WEIGHT
    if spec.kind == "logistic":
        # an inverse penalty C on the summed loss is 1 / (C x total weight) on the mean loss
        penalty = 1.0 / (params.pop("C") * weight_total)
        return LogisticRegression(regParam=penalty, elasticNetParam=0.0, standardization=False, **common, **params)
    if spec.kind == "forest":
        return RandomForestClassifier(seed=SEED, cacheNodeIds=True, checkpointInterval=10, **common, **params)
    if spec.kind == "boosted":
        return GBTClassifier(seed=SEED, checkpointInterval=10, **common, **params)
    raise ValueError(f"unknown model kind {spec.kind!r}")


def laid_out(df: DataFrame, key: str, columns: Sequence[str], tasks: int | None = None) -> DataFrame:
    """The layout of a fit: rows by key in ``tasks`` sorted partitions, wherever they came from.

    Forests and boosting draw their samples per partition, so this makes a fit depend on
    the rows alone. ``tasks`` is the session's number of shuffle partitions unless given;
    it doesn't follow the data. Without the key column the features take its place.
    """
    tasks = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [key] if key in df.columns else [*columns, LABEL]
    return df.repartition(tasks, *order).sortWithinPartitions(*order)


def fit_model(train: DataFrame, spec: ModelSpec, columns: Sequence[str], key: str = specs.KEY,
              tasks: int | None = None, laid: bool = False) -> PipelineModel:
    """Fit one model; the result carries its own assembling and scaling.

    ``train`` needs the label and the feature columns, and is best written. ``key`` and
    ``tasks`` fix the layout, see :func:`laid_out`; ``laid`` rows have theirs already.
    """
    counts = class_counts(train)
    rows = sum(counts.values())
    weighted = with_class_weights(train, counts=counts) if spec.balanced else train
    weighted = fill_nulls(weighted, columns)
    if not laid:
        weighted = laid_out(weighted, key, columns, tasks)
    stages = [VectorAssembler(inputCols=list(columns), outputCol="assembled", handleInvalid="error")]
    features = "assembled"
    if spec.scaled:
        stages.append(StandardScaler(inputCol="assembled", outputCol="sample_scaled", withMean=True, withStd=True))
        # sample deviation -> population deviation
        widen = Vectors.dense([math.sqrt(rows / max(rows - 1, 1))] * len(columns))
        stages.append(ElementwiseProduct(scalingVec=widen, inputCol="sample_scaled", outputCol="scaled"))
        features = "scaled"
    # balanced weights sum to the number of rows
    stages.append(_classifier(spec, features, float(rows)))
    model = Pipeline(stages=stages).fit(weighted)
    _without_summary(model.stages[-1])
    return model


def _without_summary(fitted) -> None:
    """Lets go of a fit's training summary, as saving and loading the model would.

    The summary holds the session, which can't be sent to tasks once a write was observed in it.
    """
    if getattr(fitted, "hasSummary", False):
        fitted._java_obj.setSummary(SparkContext._active_spark_context._jvm.scala.Option.empty())


def score(model: PipelineModel, df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """P(1) and the class at 0.5, beside the kept columns; feature nulls count as 0."""
    ready = fill_nulls(df, columns)
    scored = model.transform(ready)
    return scored.select(
        *keep,
        vector_to_array("probability")[1].alias("probability"),
        F.col("prediction").cast("int").alias("prediction"),
    )


def evaluate(scored: DataFrame) -> dict[str, float]:
    """The six headline metrics of a scored table."""
    return binary_metrics(scored, "probability", LABEL, "prediction").first().asDict()


def cross_validate(train: DataFrame, spec: ModelSpec, columns: Sequence[str], key: str,
                   folds: int = 5, parallelism: int = 2) -> DataFrame:
    """Exact ROC area per fold, each scored by a model fitted on the other folds.

    A linear fit draws no samples, so its rows are laid out once, as they are written, and
    not once per pass and fold.
    """
    folded = with_folds(train, key, folds)
    laid = spec.kind == "logistic"
    folded = settle(laid_out(folded, key, columns) if laid else folded)

    def one(fold: int) -> tuple[str, int, float]:
        model = fit_model(folded.filter(F.col(FOLD) != fold), spec, columns, laid=laid)
        held = score(model, folded.filter(F.col(FOLD) == fold), columns, keep=[LABEL])
        area = ranking_metrics(held, "probability", LABEL).first()
        return spec.name, fold, area["auc_roc"]

    with ThreadPoolExecutor(parallelism) as pool:  # each thread works in the caller's scratch scope
        rows = [done.result() for done in [pool.submit(copy_context().run, one, fold) for fold in range(folds)]]
    return train.sparkSession.createDataFrame(rows, "model string, fold int, auc_roc double")


def cv_summary(folds: DataFrame) -> DataFrame:
    """Mean and population deviation of the fold areas per model."""
    return folds.groupBy("model").agg(
        F.avg("auc_roc").alias("cv_auc_mean"), F.stddev_pop("auc_roc").alias("cv_auc_std")
    )


def feature_importance(model: PipelineModel, columns: Sequence[str], spark, k: int | None = 20) -> DataFrame:
    """Impurity importances of a tree model, highest first."""
    values = model.stages[-1].featureImportances.toArray()
    table = spark.createDataFrame(
        [(c, float(v)) for c, v in zip(columns, values)], "feature string, importance double"
    )
    order = [F.col("importance").desc(), F.col("feature")]
    return top_k(table, k, *order) if k else table.orderBy(*order)


def coefficients(model: PipelineModel, columns: Sequence[str], spark) -> DataFrame:
    """Signed and absolute coefficients of a linear model."""
    values = model.stages[-1].coefficients.toArray()
    return spark.createDataFrame(
        [(c, float(v), abs(float(v))) for c, v in zip(columns, values)],
        "feature string, coefficient double, abs_coefficient double",
    )


def drivers(coefs: DataFrame, k: int = 10) -> DataFrame:
    """The k strongest positive (driver) and negative (protector) coefficients."""
    up = top_k(coefs.filter("coefficient > 0"), k, F.col("coefficient").desc(), F.col("feature"))
    down = top_k(coefs.filter("coefficient < 0"), k, F.col("coefficient"), F.col("feature"))
    return up.withColumn("role", F.lit("driver")).unionByName(down.withColumn("role", F.lit("protector")))


# --- runs ------------------------------------------------------------------------------

RUN_SCHEMA = (
    "run_id string, run_name string, started_at timestamp, params map<string,string>, "
    "metrics map<string,double>, model_path string, features array<string>"
)
# fixed values: the metrics repeated on the best run
BEST_METRICS = ["auc_roc", "f1", "precision", "recall", "cv_auc_mean"]


def log_run(lake, name: str, params: Mapping[str, object], metrics: Mapping[str, float],
            model_path: str = "", features: Sequence[str] = (), table: str = "gold.ml_runs") -> str:
    """Append one run to the run table and return its id."""
    run_id = uuid.uuid4().hex
    row = (
        run_id, name, datetime.now(timezone.utc).replace(tzinfo=None),
        {k: str(v) for k, v in params.items()},
        {k: float(v) for k, v in metrics.items() if v is not None},
        model_path, list(features),
    )
    lake.write(lake.spark.createDataFrame([row], RUN_SCHEMA).coalesce(1), table, mode="append")
    return run_id


def model_comparison(runs: DataFrame) -> DataFrame:
    """One row per run with its metrics, best ROC area first."""
    names = ["auc_roc", "f1", "precision", "recall", "accuracy", "cv_auc_mean", "cv_auc_std", "avg_precision"]
    return runs.select(
        F.col("run_name").alias("model"), *[F.col("metrics")[n].alias(n) for n in names]
    ).orderBy(F.col("auc_roc").desc(), "model")


def select_best_run(runs: DataFrame, prefix: str = "BEST_") -> DataFrame:
    """The best run by ROC area among those marked best, or among all if none is."""
    marked = F.col("run_name").startswith(prefix)
    return top_k(
        runs.withColumn("_area", F.col("metrics")["auc_roc"]), 1,
        marked.cast("int").desc(), F.col("_area").desc_nulls_last(), F.col("run_id"),
    ).drop("_area")


def auc_sanity(areas: DataFrame, column: str = "auc_roc") -> DataFrame:
    """Signal, no signal or mixed over all models, and whether any area smells of leakage."""
    return areas.agg(F.min(column).alias("lowest"), F.max(column).alias("highest")).select(
        "lowest", "highest",
        F.when(F.col("lowest") > specs.AUC_SIGNAL, "signal")
        .when(F.col("highest") < specs.AUC_NO_SIGNAL, "no signal")
        .otherwise("mixed").alias("verdict"),
        (F.col("highest") > specs.AUC_LEAKAGE).alias("leakage_warning"),
    )


def training_summary(features: DataFrame, columns: Sequence[str], runs: DataFrame) -> DataFrame:
    """Data set, split and best result in one row; ``features`` has the split column."""
    best = select_best_run(runs)
    return features.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(columns)).alias("n_features"),
        (F.avg(LABEL) * 100).alias("attrition_pct"),
        F.count_if(F.col(SPLIT) == "train").alias("n_train"),
        F.count_if(F.col(SPLIT) == "test").alias("n_test"),
    ).select(
        "*", best.select("run_name").scalar().alias("best_run"),
        best.select(F.col("metrics")["auc_roc"]).scalar().alias("best_auc"),
    )


def train_all(lake, features: DataFrame, key: str, models: Sequence[ModelSpec] = MODELS,
              exclude: Sequence[str] = (), folds: int = 5, test_share: float = 0.20,
              model_root: str = "") -> str:
    """Split, fit, evaluate and log every model; log and save the best; return its run id."""
    columns = feature_names(features, [key, *exclude])
    split = stratified_split(fill_nulls(features, columns), key, LABEL, test_share).cache()
    train, test = split.filter(F.col(SPLIT) == "train"), split.filter(F.col(SPLIT) == "test")
    results = {}
    try:
        sizes = {r[0]: r[1] for r in split.groupBy(SPLIT).count().collect()}
        for spec in models:
            model = fit_model(train, spec, columns)
            metrics = evaluate(score(model, test, columns, keep=[LABEL]))
            if folds:
                cv = cv_summary(cross_validate(train, spec, columns, key, folds)).first()
                metrics |= {"cv_auc_mean": cv["cv_auc_mean"], "cv_auc_std": cv["cv_auc_std"]}
            params = {
                "model_type": spec.name, "n_features": len(columns), "feature_scaling": spec.scaled,
                "train_size": sizes.get("train", 0), "test_size": sizes.get("test", 0),
                "class_weight": "balanced" if spec.balanced else "none", **spec.params,
            }
            log_run(lake, spec.name, params, metrics, features=columns)
            results[spec.name] = (model, metrics)
        # a test split of one class has no area
        best = max(results, key=lambda name: -1.0 if results[name][1]["auc_roc"] is None else results[name][1]["auc_roc"])
        model, metrics = results[best]
        root = model_root or f"{shared_dir(features.sparkSession)}/models"
        path = f"{root}/{best.replace(' ', '_')}-{uuid.uuid4().hex}"
        model.write().overwrite().save(path)
        counts = class_counts(split)
        params = {
            "model_type": best, "is_best": True, "n_features": len(columns),
            "n_samples": sum(counts.values()),
            "attrition_rate": counts.get(1, 0) / max(sum(counts.values()), 1),
        }
        best_metrics = {m: metrics[m] for m in BEST_METRICS if m in metrics}
        return log_run(lake, f"BEST_{best}", params, best_metrics, path, columns)
    finally:
        split.unpersist()
