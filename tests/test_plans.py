"""Layered plans: analytics, splits, runs, quality, build."""

import pytest
from pyspark.sql import functions as F

from tenura import specs
from tenura.operators import joins, quality
from tenura.plans import analytics, data_tests, flow, registry, scoring, star, training
from tenura.session import scratch_path, scratch_scope, settle, shared_dir
from tenura.sources import readers
from tenura.sources.people import people
from tenura.sources.tables import Lake

FEATURES = ["overtime", "job_level", "stock_option_level", "monthly_income", "age"]


@pytest.fixture
def lake(spark):
    path = scratch_path(spark, "lake")
    return Lake(spark, root=path, prefix=f"t{path[-10:]}_")


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_one_pass_cuts_equal_the_union(clean):
    one, many = analytics.attrition_analytics(clean), analytics.attrition_analytics_by_union(clean)
    assert rows(one) == rows(many)
    totals = {r[0]: r[1] for r in one.groupBy("dimension_name").agg(F.sum("total_employees")).collect()}
    assert set(totals.values()) == {clean.count()} and len(totals) == 14


def test_cuts_keep_null_groups(spark, clean):
    holed = clean.withColumn("department", F.when(F.col("employee_number") > 9, F.col("department")))
    cut = analytics.attrition_analytics(holed).filter("dimension_name = 'Department' and dimension_value is null")
    assert cut.first().total_employees == 10


def test_lookup_join_keeps_rows_and_refuses_repeated_keys(clean):
    dims = star.dimensions(clean)
    on = {"job_role": "job_role_name", "department": "department_name"}
    small = joins.lookup_join(clean.select("employee_number", "job_role", "department"), dims.tables["dim_job_role"], on)
    large = joins.lookup_join(clean.select("employee_number", "job_role", "department"), dims.tables["dim_job_role"], on, known_unique=True)
    assert rows(small) == rows(large) and small.count() == clean.count()
    twice = dims.tables["dim_job_role"].unionByName(dims.tables["dim_job_role"])
    with pytest.raises(ValueError, match="twice"):
        joins.lookup_join(clean, twice, on)


def test_dimensions_at_once_equal_one_by_one(clean):
    together = star.dimensions(clean)
    assert together.unique
    for name in star.DIMENSIONS:
        assert rows(together.tables[name]) == rows(star.dimension(clean, name))


def test_people_do_not_overflow_at_large_keys(spark):
    big = 10**12 + 7
    modulus = 1000003 * 1000033 * 1000037  # beyond what the plain product could hold
    keys = spark.createDataFrame([(5,), (big,), (modulus % (2**62),)], "o_orderkey bigint")
    assert people(keys).count() == 3
    first = people(keys).filter("EmployeeNumber = 5").first()
    assert first.DailyRate == 100 + (25 * 7919 + 5 * 104729 + 13) % 1000003 % 1400


# --- splits, folds, weights ---------------------------------------------------------


def test_stratified_split_is_exact_per_class(clean):
    split = training.stratified_split(clean, specs.KEY, "attrition", 0.2)
    counts = {(r[0], r[1]): r[2] for r in split.groupBy("attrition", "split").count().collect()}
    for label, n in training.class_counts(clean).items():
        assert counts[(label, "test")] == round(0.2 * n) and counts[(label, "train")] == n - round(0.2 * n)
    again = training.stratified_split(clean.repartition(7), specs.KEY, "attrition", 0.2)
    assert rows(split.select(specs.KEY, "split")) == rows(again.select(specs.KEY, "split"))


def test_split_survives_many_keys_on_one_hash(spark):
    """Keys that share one hash value: the cut-off falls inside a tie."""
    keys = spark.range(40).select((F.col("id") * training.HASH_MODULUS).alias("k"), (F.col("id") % 2).cast("int").alias("y"))
    split = training.stratified_split(keys, "k", "y", 0.25)
    counts = {(r[0], r[1]): r[2] for r in split.groupBy("y", "split").count().collect()}
    assert counts == {(0, "test"): 5, (0, "train"): 15, (1, "test"): 5, (1, "train"): 15}


def test_folds_are_stratified(clean):
    folds = training.with_folds(clean, specs.KEY)
    assert folds.count() == clean.count()
    sizes = {}
    for r in folds.groupBy("attrition", "fold").count().collect():
        sizes.setdefault(r.attrition, []).append(r["count"])
    assert all(len(s) == 5 and max(s) - min(s) <= 1 for s in sizes.values())


def test_fits_depend_on_the_rows_alone(clean):
    rows = clean.select(specs.KEY, "attrition", *FEATURES).filter(f"{specs.KEY} < 400")
    for spec in (small("forest", numTrees=4, maxDepth=4), small("boosted", maxIter=3, maxDepth=3, subsamplingRate=0.7)):
        one, three = (training.fit_model(rows.repartition(n), spec, FEATURES) for n in (1, 3))
        assert one.stages[-1].featureImportances == three.stages[-1].featureImportances


def test_class_counts_refuse_other_labels(spark):
    with pytest.raises(ValueError, match="0 or 1"):
        training.class_counts(spark.createDataFrame([(0,), (2,)], "attrition int"))


def test_scopes_of_two_builds_overlap(spark):
    import contextvars

    first, second = contextvars.copy_context(), contextvars.copy_context()
    outer, inner = scratch_scope(spark), scratch_scope(spark)
    first.run(outer.__enter__)
    kept = first.run(settle, spark.range(7))
    second.run(inner.__enter__)
    gone = second.run(settle, spark.range(3))
    second.run(inner.__exit__, None, None, None)
    assert kept.count() == 7
    with pytest.raises(Exception, match="exist|FILE|PATH"):
        gone.collect()
    first.run(outer.__exit__, None, None, None)


def test_a_failing_declared_test_stops_the_build(lake, raw):
    spoilt = raw.withColumn("Gender", F.when(F.col("EmployeeNumber") == 3, "?").otherwise(F.col("Gender")))
    with pytest.raises(AssertionError, match="Gender accepted"):
        flow.run(lake, spoilt, expected=1470, models=[small("logistic", maxIter=1)])
    log = lake.read(flow.RUN_TABLE).collect()
    assert [(r.task, r.status) for r in log] == [("raw load", "FAIL")] and "Gender" in log[0].details


def test_folds_partition_and_weights_balance(clean):
    folds = training.with_folds(clean, specs.KEY)
    sizes = {r[0]: r[1] for r in folds.groupBy("fold").count().collect()}
    assert sorted(sizes) == [0, 1, 2, 3, 4] and sum(sizes.values()) == clean.count()
    weights = training.with_class_weights(clean).groupBy("attrition").agg(F.sum("weight").alias("w")).collect()
    assert [r.w for r in weights] == pytest.approx([clean.count() / 2] * 2)


def test_scaling_handles_a_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    out = training.apply_scaling(df, training.fit_scaling(df, ["a", "b"])).orderBy("a").collect()
    assert [(r.a, r.b) for r in out] == [(-1.0, 0.0), (1.0, 0.0)]


# --- models, runs, scoring --------------------------------------------------------------


def small(kind, **params):
    base = {"logistic": training.LOGISTIC, "forest": training.FOREST, "boosted": training.BOOSTED}[kind]
    return training.ModelSpec(base.name, kind, base.scaled, base.balanced, {**base.params, **params})


def test_logistic_minimises_the_penalised_weighted_loss(clean):
    """At the optimum the gradient of C * sum(weighted loss) + |w|^2 / 2 is zero."""
    import numpy as np

    model = training.fit_model(clean, training.LOGISTIC, FEATURES)
    pdf = clean.select("attrition", *FEATURES).toPandas()
    x = pdf[FEATURES].to_numpy(float)
    x = (x - x.mean(0)) / x.std(0)
    y = pdf["attrition"].to_numpy(float)
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    fitted = model.stages[-1]
    w = fitted.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ w + fitted.intercept)))
    gradient = 0.1 * (weight * (p - y)) @ x + w
    assert np.abs(gradient).max() < 1e-2 and np.abs(0.1 * (weight * (p - y)).sum()) < 1e-2


@pytest.mark.parametrize("spec", [small("forest", numTrees=5, maxDepth=4), small("boosted", maxIter=3)])
def test_tree_models_fit_and_rank_features(spark, clean, spec):
    model = training.fit_model(clean, spec, FEATURES)
    table = training.feature_importance(model, FEATURES, spark, 3).collect()
    assert len(table) == 3 and table[0].importance >= table[1].importance
    scored = training.score(model, clean, FEATURES, keep=["attrition"])
    assert scored.filter("probability < 0 or probability > 1").count() == 0
    assert training.evaluate(scored)["auc_roc"] > 0.5


def test_cross_validation_returns_every_fold(clean):
    folds = training.cross_validate(clean, small("logistic", maxIter=10), FEATURES, specs.KEY)
    assert sorted(r.fold for r in folds.collect()) == [0, 1, 2, 3, 4]
    assert training.cv_summary(folds).first().cv_auc_mean == pytest.approx(
        sum(r.auc_roc for r in folds.collect()) / 5)


def test_best_run_lookup_and_fallback(lake):
    for name, auc in (("A", 0.7), ("B", 0.8), ("BEST_A", 0.75)):
        training.log_run(lake, name, {"a": 1}, {"auc_roc": auc})
    runs = lake.read("gold.ml_runs")
    assert training.select_best_run(runs).first().run_name == "BEST_A"
    assert training.select_best_run(runs.filter("run_name not like 'BEST%'")).first().run_name == "B"
    assert [r.model for r in training.model_comparison(runs).collect()] == ["B", "BEST_A", "A"]


@pytest.mark.parametrize("areas, verdict, leakage", [
    ([.84, .78, .79], "signal", False), ([.5, .51], "no signal", False),
    ([.7, .97], "signal", True), ([.5, .7], "mixed", False)])
def test_auc_sanity(spark, areas, verdict, leakage):
    row = training.auc_sanity(spark.createDataFrame([(a,) for a in areas], "auc_roc double")).first()
    assert (row.verdict, row.leakage_warning) == (verdict, leakage)


def test_drivers(spark):
    table = spark.createDataFrame([("a", 2.0, 2.0), ("b", -1.0, 1.0), ("c", 0.5, 0.5)],
                                  "feature string, coefficient double, abs_coefficient double")
    assert [(r.feature, r.role) for r in training.drivers(table, 1).collect()] == [("a", "driver"), ("b", "protector")]


# --- quality ------------------------------------------------------------------------------


def test_there_are_68_declared_tests():
    kinds = [c.test for c in data_tests.DECLARED]
    assert len(kinds) == 68
    assert [kinds.count(k) for k in ("not_null", "unique", "accepted_values", "relationships")] == [45, 7, 11, 5]


def test_each_kind_of_test_fails_on_its_own(spark):
    bad = spark.createDataFrame(
        [(1, "Yes", 10), (1, "Maybe", 10), (2, None, 99), (None, "No", None)], "id int, answer string, fk int")
    parent = spark.createDataFrame([(10,), (10,), (11,)], "key int")
    checks = [
        *quality.not_null("bad", "id", "answer"), *quality.unique("bad", "id"),
        quality.accepted("bad", "answer", "Yes", "No"), quality.relationship("bad", "fk", "parent", "key"),
        quality.min_rows("bad", 5), quality.same_rows("bad", "parent"), quality.min_rows("empty", 1),
        *quality.not_null("empty", "id"),
    ]
    tables = {"bad": bad, "parent": parent, "empty": bad.limit(0)}
    report = quality.run_checks(tables, checks)
    # the form for large parents finds the same
    assert rows(quality.run_checks(tables, checks, max_parents=0)) == rows(report)
    found = [(r.table_name, r.column_name, r.test, r.failures, r.status) for r in report.collect()]
    assert sorted(found) == sorted([
        ("bad", "id", "not_null", 1, "fail"), ("bad", "answer", "not_null", 1, "fail"),
        ("bad", "id", "unique", 1, "fail"), ("bad", "answer", "accepted_values", 1, "fail"),
        ("bad", "fk", "relationships", 1, "fail"), ("bad", "*", "min_rows", 1, "fail"),
        ("bad", "*", "row_preservation", 1, "fail"), ("empty", "*", "min_rows", 1, "fail"),
        ("empty", "id", "not_null", 0, "pass"),
    ])
    with pytest.raises(AssertionError, match="bad.id unique: 1"):
        quality.require(report)
    quality.require(report.filter("status = 'pass'"))


# --- tables, reading, the whole build --------------------------------------------------------


def test_first_available_and_missing(spark):
    path = scratch_path(spark, "csv")
    spark.range(3).write.option("header", True).csv(path)
    assert readers.scan_first_available(spark, [path + "-no", path], "id bigint").count() == 3
    with pytest.raises(FileNotFoundError, match="upload the CSV"):
        readers.scan_first_available(spark, [path + "-no"])


def test_overwrite_replaces_the_schema(lake):
    lake.write(lake.spark.range(3), "silver.t")
    lake.write(lake.spark.range(2).selectExpr("id as a", "'x' as b"), "silver.t")
    assert lake.read("silver.t").columns == ["a", "b"] and lake.read("silver.t").count() == 2
    assert lake.has_rows("silver.t", 2) and not lake.has_rows("silver.t", 3) and not lake.has_rows("silver.u", 1)


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert settle(spark.range(5)).count() == 5


def test_whole_build_runs_and_repeats(spark, lake, raw):
    models = [small("logistic", maxIter=5), small("forest", numTrees=3, maxDepth=3)]
    root = scratch_path(spark, "models")
    log = flow.run(lake, raw, expected=1470, models=models, model_root=root)
    assert flow.summary(log).first().all_passed
    again = flow.run(lake, raw, expected=1470, models=models, model_root=root)
    first = again.orderBy("position").first()
    assert first.details.startswith("already loaded")
    table = lake.read(data_tests.PREDICTIONS)
    assert table.columns == specs.PREDICTION_COLUMNS and table.count() == raw.count()
    assert lake.read("gold.ml_runs").count() == 6
    stored = {c.table: lake.read(c.table) for c in data_tests.DECLARED}
    quality.require(quality.run_checks(stored, data_tests.DECLARED))
    # the keys of fact and predictions name the same people
    fact = lake.read(data_tests.FACT).select("employee_key", "department", "job_role", "age", "monthly_income")
    other = table.selectExpr("employee_key", "department_name as department", "job_role_name as job_role", "age", "monthly_income")
    assert fact.exceptAll(other).count() == 0


def test_a_failing_task_stops_and_is_logged(lake, raw):
    with pytest.raises(AssertionError, match="min_rows"):
        flow.run(lake, raw, expected=10**9, models=[small("logistic", maxIter=1)])
    log = lake.read(flow.RUN_TABLE).collect()
    assert [(r.task, r.status) for r in log] == [("raw load", "FAIL")]


def statuses(log):
    return [r.status for r in log.orderBy("position").collect()]


def test_a_build_resumes_where_something_changed(spark, lake, raw):
    build = lambda source=raw, **more: flow.run(lake, source, 1470, models=[], if_exists="changed", resume=True, **more)
    assert statuses(build()) == ["PASS"] * 5
    assert statuses(build(raw.repartition(3))) == ["PASS", "SKIP", "SKIP", "SKIP", "SKIP"]  # the same rows in another order
    # a table that somebody changed is made anew, and as it is what it was, nothing after it
    lake.write(settle(lake.read(data_tests.CLEAN).limit(5)), data_tests.CLEAN)
    assert statuses(build()) == ["PASS", "PASS", "SKIP", "SKIP", "SKIP"]
    # another source starts everything
    other = raw.withColumn("DailyRate", F.when(F.col("EmployeeNumber") == 3, -1).otherwise(F.col("DailyRate")))
    assert statuses(build(other)) == ["PASS"] * 5
    spark.sql(f"DROP TABLE {lake.full_name(data_tests.FACT)}")
    assert statuses(build(other)) == ["PASS", "SKIP", "SKIP", "PASS", "SKIP"]
    wrote = {r.table_name: r.fingerprint for r in flow.tables_of(lake.read(flow.RUN_TABLE).filter("status = 'PASS'")).collect()}
    assert len(wrote) == 10


def test_a_failed_task_is_done_again(lake, raw):
    spoilt = raw.withColumn("Age", F.when(F.col("EmployeeNumber") == 3, F.lit(None)).otherwise(F.col("Age")))
    with pytest.raises(AssertionError, match="Age not_null: 1"):
        flow.run(lake, spoilt, 1470, models=[], if_exists="changed", resume=True)
    assert statuses(flow.run(lake, raw, 1470, models=[], if_exists="changed", resume=True)) == ["PASS"] * 5


def test_tests_counted_while_writing_equal_scans(lake, raw):
    spoilt = raw.withColumn("Age", F.when(F.col("EmployeeNumber") % 9 == 3, F.lit(None)).otherwise(F.col("Age")))
    spoilt = spoilt.withColumn("Gender", F.when(F.col("EmployeeNumber") % 9 == 3, "?").otherwise(F.col("Gender")))
    checks = [*data_tests.RAW_CHECKS, quality.min_rows(data_tests.RAW, 10), quality.min_rows(data_tests.RAW, 10**7)]
    observed = {data_tests.RAW: lake.write_observed(spoilt, data_tests.RAW, checks)}
    stored = {data_tests.RAW: lake.read(data_tests.RAW)}
    assert rows(quality.run_checks(stored, checks)) == rows(quality.run_checks(stored, checks, observed=observed))
    assert observed[data_tests.RAW].fingerprint == quality.fingerprint(spoilt.repartition(5)) == quality.fingerprint(stored[data_tests.RAW])
    assert quality.fingerprint(raw) != quality.fingerprint(spoilt)


def test_bucketed_tables_join_without_an_exchange(spark, lake):
    lake.bucketed(spark.range(1000).withColumnRenamed("id", "k"), "silver.a", "k", 4)
    lake.bucketed(spark.range(500, 1500).withColumnRenamed("id", "k"), "silver.b", "k", 4)
    joined = lake.read("silver.a").join(lake.read("silver.b").hint("merge"), "k", "left_anti")
    assert joined.count() == 500
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan


def test_dense_keys_and_splits_make_their_input_once(spark):
    """Numbering samples its order, and a split counts before it marks; neither makes the rows again."""
    from tenura.operators.ordering import dense_key

    made = spark.sparkContext.accumulator(0)

    def touch(frames):
        for frame in frames:
            made.add(len(frame))
            yield frame

    df = spark.range(300).select(F.col("id").alias("k"), (F.col("id") % 2).cast("int").alias("attrition")).mapInPandas(touch, "k long, attrition int")
    assert dense_key(df, ["k"], "n").count() == 300 and made.value == 300
    assert training.stratified_split(df, "k", "attrition", 0.2).filter("split = 'test'").count() == 60 and made.value == 600


def test_build_by_tag(lake, raw):
    lake.create_view(raw, data_tests.RAW)
    assert list(registry.build(lake, ["silver"])) == [data_tests.CLEAN]
    assert len(registry.build(lake, ["dimension"])) == 5
    view = registry.Model("gold.half", lambda at: at.read(data_tests.CLEAN).filter("attrition = 1"), frozenset({"x"}), "view")
    registry.build(lake, ["x"], [view])
    assert lake.read("gold.half").count() == raw.filter("Attrition = 'Yes'").count()


def test_linear_score_and_tiers(spark):
    df = spark.createDataFrame([(0.0,), (None,), (100.0,)], "x double")
    out = scoring.with_risk(scoring.score_linear(df, {"x": 1.0}, 0.0)).collect()
    assert [(r.attrition_probability, r.predicted_attrition, r.risk_tier) for r in out] == [
        (0.5, 0, "Medium"), (0.5, 0, "Medium"), (1.0, 1, "High")]


def test_linear_folds_are_laid_out_once(spark, monkeypatch):
    calls, plain = [], training.laid_out
    monkeypatch.setattr(training, "laid_out", lambda *a, **b: calls.append(1) or plain(*a, **b))
    rows = spark.createDataFrame([(i, i % 3 % 2, float(i % 7), float(i % 5)) for i in range(120)], "k long, attrition int, x double, y double")
    areas = training.cross_validate(rows, training.LOGISTIC, ["x", "y"], "k", folds=2).collect()
    assert [r["fold"] for r in areas] == [0, 1] and all(0 <= r["auc_roc"] <= 1 for r in areas)
    assert len(calls) == 1
