"""Tests of association, ranking metrics and profiles on hand-computed cases."""

import math

import pytest
from pyspark.sql import functions as F

from tenura.functions.pvalues import chi2_tail, normal_tail, student_tail
from tenura.operators import aggregate, profile, ranking, stats


def table(spark, cells):
    """Rows with the given counts per (level, class)."""
    rows = [(f"r{i}", f"c{j}") for i, line in enumerate(cells) for j, n in enumerate(line) for _ in range(n)]
    return spark.createDataFrame(rows, "x string, y string")


@pytest.mark.parametrize("x, dof", [
    (3.841458820694124, 1), (5.991464547107979, 2), (7.814727903251179, 3), (9.487729036781154, 4)])
def test_chi2_tail(x, dof):
    assert chi2_tail(x, dof) == pytest.approx(0.05, abs=1e-12)


def test_tails_at_the_edges():
    assert chi2_tail(0, 3) == 1.0 and normal_tail(0) == 1.0 and student_tail(0, 5) == pytest.approx(1.0)
    assert student_tail(math.inf, 5) == 0.0 and math.isnan(student_tail(1.0, 0))
    assert student_tail(2.2281388519649385, 10) == pytest.approx(0.05, abs=1e-10)
    assert student_tail(1.959963984540054, 1e9) == pytest.approx(0.05, abs=1e-9)
    assert student_tail(1.9600, 5_000_000) == pytest.approx(normal_tail(1.96), abs=1e-6)


@pytest.mark.parametrize("cells, chi2, dof, p, v", [
    ([(10, 20), (30, 5)], 16.578482, 1, 4.66776e-05, 0.505028),
    ([(10, 20, 30), (20, 20, 20)], 5.333333, 2, 0.0694835, 0.210819),
    ([(10, 20, 30), (20, 20, 20), (5, 15, 25)], 10.126984, 4, 0.0383421, 0.175179),
])
def test_chi_squared(spark, cells, chi2, dof, p, v):
    row = stats.chi_squared(table(spark, cells), ["x"], "y", 0.05).first()
    assert row.chi2 == pytest.approx(chi2, abs=1e-6) and row.dof == dof
    assert row.p_value == pytest.approx(p, rel=1e-4) and row.cramers_v == pytest.approx(v, abs=1e-6)
    assert row.significant == (p < 0.05)


def test_chi_squared_with_an_empty_cell_and_a_constant_column(spark):
    row = stats.chi_squared(table(spark, [(10, 0), (5, 5)]), ["x"], "y", 0.05).first()
    # expected (7.5, 2.5): every cell is off by 2.5, by 2 after the correction
    assert row.chi2 == pytest.approx(4 / 7.5 * 2 + 4 / 2.5 * 2)
    flat = stats.chi_squared(table(spark, [(10, 3)]), ["x"], "y", 0.05).first()
    assert (flat.dof, flat.chi2, flat.p_value, flat.cramers_v) == (0, 0.0, 1.0, 0.0)


def test_mann_whitney(spark):
    rows = [(v, 1) for v in (3, 5, 5, 8)] + [(v, 0) for v in (1, 2, 4, 5, 6, 7, 9, 9, 10)]
    df = spark.createDataFrame(rows + [(None, 1)], "v int, f int")
    for small in (True, False):
        row = stats.mann_whitney(df, "v", "f", known_small=small).first()
        assert (row.u, row.n_pos, row.n_neg) == (15.0, 4, 9)
        assert row.z == pytest.approx(0.388435, abs=1e-6)
        assert row.p_value == pytest.approx(0.697694, abs=1e-6)
        assert row.auc == pytest.approx(0.416667, abs=1e-6)
    assert stats.mann_whitney(df.filter("f = 1"), "v", "f").count() == 0


def test_binary_metrics(spark):
    rows = [(.9, 1), (.8, 0), (.8, 1), (.4, 0), (.3, 1), (.1, 0)]
    df = spark.createDataFrame(rows, "s double, y int").withColumn("p", (F.col("s") > 0.5).cast("int"))
    row = ranking.binary_metrics(df, "s", "y", "p").first()
    assert row.avg_precision == pytest.approx(0.755556, abs=1e-6)
    assert row.auc_roc == pytest.approx(0.722222, abs=1e-6)
    assert (row.accuracy, row.precision, row.recall) == pytest.approx((4 / 6, 2 / 3, 2 / 3))
    matrix = {(r.actual, r.predicted): r.n for r in ranking.confusion_matrix(df, "y", "p").collect()}
    assert matrix == {(0, 0): 2, (0, 1): 1, (1, 0): 1, (1, 1): 2}
    roc = ranking.roc_curve(df, "s", "y").orderBy(F.col("threshold").desc()).collect()
    assert [(r.fpr, r.tpr) for r in roc][-1] == (1.0, 1.0) and len(roc) == 6
    assert (roc[0].threshold, roc[0].fpr, roc[0].tpr) == (float("inf"), 0.0, 0.0)
    pr = ranking.pr_curve(df, "s", "y").orderBy(F.col("threshold").desc()).first()
    assert (pr.precision, pr.recall, pr.base_rate) == (1.0, 0.0, 0.5)


def test_metrics_of_one_class_and_of_nothing(spark):
    df = spark.createDataFrame([(.2, 0), (.4, 0)], "s double, y int").withColumn("p", F.lit(0))
    row = ranking.binary_metrics(df, "s", "y", "p").first()
    assert (row.precision, row.recall, row.f1, row.accuracy) == (0.0, 0.0, 0.0, 1.0) and row.auc_roc is None
    empty = ranking.confusion_matrix(df.filter("y = 1"), "y", "p")
    assert [r.n for r in empty.collect()] == [0, 0, 0, 0]


def test_correlations_drop_nulls_by_pair(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 5.0), (2.0, 4.0, None), (3.0, 6.5, 1.0), (4.0, None, 0.0), (5.0, 9.0, -3.0)],
        "a double, b double, c double")
    mine = {(r.a, r.b): r.r for r in stats.pearson_matrix(df, ["a", "b", "c"]).collect()}
    expected = df.toPandas().corr()
    for (a, b), r in mine.items():
        assert r == pytest.approx(expected.loc[a, b])
    whole = df.na.drop()
    mine = {(r.a, r.b): r.r for r in stats.pearson_matrix(whole, ["a", "b", "c"]).collect()}
    for (a, b), r in mine.items():
        assert r == pytest.approx(whole.toPandas().corr().loc[a, b])


def test_weak_features_fall_back_to_the_weakest(spark):
    rows = [(f"f{i}", 0.1 * (i + 1)) for i in range(7)]
    df = spark.createDataFrame(rows, "feature string, abs_corr double")
    assert {r.feature for r in stats.weak_features(df, 0.25).collect()} == {"f0", "f1"}
    assert {r.feature for r in stats.weak_features(df, 0.01).collect()} == {f"f{i}" for i in range(5)}


def test_associations_off_the_happy_path(spark):
    nan = float("nan")
    rows = [(1.0, 7.0, nan, None, i % 2, float(i)) for i in range(20)] + [(1.0, 7.0, 2.0, None, 1, 3.0), (1.0, 7.0, 2.0, None, 0, 3.0)]
    df = spark.createDataFrame(rows, "one double, flat double, holed double, empty double, f int, v double")
    columns = ["one", "flat", "holed", "empty", "v"]
    found = {r.feature: r for r in stats.point_biserial(df, columns, "f", 0.05).collect()}
    assert found["v"].position == 1 and found["v"].p_value is not None
    for name in columns[:4]:
        assert found[name].correlation is None and found[name].p_value is None and found[name].significant is False
    assert found["holed"].n == 2 and found["empty"].n == 0
    matrix = {(r.a, r.b): r.r for r in stats.pearson_matrix(df, columns).collect()}
    assert len(matrix) == 25 and matrix["v", "v"] == 1.0
    assert all(r is None for pair, r in matrix.items() if pair != ("v", "v"))
    large = df.select((F.col("v") + 1e9).alias("a"), (F.col("v") * -2 + 1e9).alias("b"))
    assert {(r.a, r.b): round(r.r, 9) for r in stats.pearson_matrix(large, ["a", "b"]).collect()}["a", "b"] == -1.0


def test_tails_of_large_tables():
    from tenura.functions.pvalues import chi2_tail, student_tail

    assert chi2_tail(2000, 999) == pytest.approx(2.924923e-69, rel=1e-5)
    assert chi2_tail(2000, 2000) == pytest.approx(0.4957947558, abs=1e-9)
    assert chi2_tail(1e6, 1e6) == pytest.approx(0.4998119368, abs=1e-9)
    assert chi2_tail(float("inf"), 5) == 0.0 and chi2_tail(0, 5) == 1.0
    for dof in (1e7, 1e8, 1e10):
        assert student_tail(1.959963984540054, dof) == pytest.approx(0.05, abs=2e-7)
    for k in (1, 2, 3, 10, 101):  # both sides of the switch of fractions agree
        for t in (0.3, 1.0, 1.7, 1.8, 4.0):
            steps = 40_000
            width, scale = t / steps, math.exp(math.lgamma((k + 1) / 2) - math.lgamma(k / 2)) / math.sqrt(k * math.pi)
            area = sum((1 + ((i + 0.5) * width) ** 2 / k) ** (-(k + 1) / 2) for i in range(steps)) * width * scale
            assert student_tail(t, k) == pytest.approx(1 - 2 * area, abs=1e-8)


def test_reports_keep_empty_columns_and_large_flat_values(spark):
    df = spark.createDataFrame([("a", 1e17, None), ("a", 1e17, None), ("b", 1.0, None)], "k string, big double, none double")
    told = {r.feature: r for r in aggregate.describe(df, ["big", "none"]).collect()}
    assert told["none"].n == 0 and told["none"]["mean"] is None and told["none"].position == 2
    bins = aggregate.histogram(df, ["big", "none"], "k", 4).collect()
    assert sum(r.n for r in bins if r.feature == "big" and r.k == "a") == 2
    assert [r.bin_start for r in bins if r.feature == "none"] == [None] * 8


def test_duplicates_count_nulls_as_equal(spark):
    df = spark.createDataFrame([("A",), ("A",), ("A",), ("B",), (None,), (None,)], "x string")
    assert aggregate.duplicate_rows(df).first()[0] == 3
    assert aggregate.duplicate_rows(df.limit(0)).first()[0] == 0


def test_constant_columns(spark):
    rows = [(1, "N" if i == 0 else "Y", "N" if i < 2 else "Y", i) for i in range(200)]
    df = spark.createDataFrame(rows, "one int, rare string, kept string, id int")
    found = {r.column_name: r.reason for r in profile.constant_columns(df, 0.01).collect()}
    assert found == {"one": "constant", "rare": "near-constant"}
    plan = {r.column_name: (r.reason, r.mode) for r in profile.drop_plan(df, 0.01, ["id"]).collect()}
    assert plan == {"one": ("constant", "1"), "rare": ("near-constant", "Y"), "id": ("id", "0")}


def test_modes_break_ties_as_numbers(spark):
    df = spark.createDataFrame([(10, "b"), (9, "a"), (10, "a"), (9, "b")], "n int, s string")
    modes = {r.feature: r["mode"] for r in aggregate.column_modes(df, ["n", "s"]).collect()}
    assert modes == {"n": "9", "s": "a"}


def test_histogram_edges_and_flat_columns(spark):
    import numpy as np

    values = [0.1 * i for i in range(31)] + [3.0, 1.5]
    df = spark.createDataFrame([("c", v, 4.0) for v in values], "k string, v double, flat double")
    out = aggregate.histogram(df, ["v", "flat"], "k", 30).orderBy("bin").collect()
    expected, _ = np.histogram(values, bins=30)
    assert [r.n for r in out if r.feature == "v"] == list(expected)
    flat = [r for r in out if r.feature == "flat"]
    assert (flat[0].bin_start, flat[-1].bin_end) == (3.5, 4.5) and sum(r.n for r in flat) == len(values)
    assert sum(r.density * (r.bin_end - r.bin_start) for r in flat) == pytest.approx(1.0)


def test_sketched_profiles_are_close(raw):
    columns = ["Age", "MonthlyIncome", "Department"]
    exact = {r.column_name: r for r in profile.schema_profile(raw, "EmployeeNumber", columns).collect()}
    near = {r.column_name: r for r in profile.schema_profile_approx(raw, columns).collect()}
    for name, row in exact.items():
        assert near[name].n_unique == pytest.approx(row.n_unique, rel=0.05)
        assert near[name].null_count == row.null_count
    exact = {r.feature: r for r in aggregate.describe(raw, ["MonthlyIncome"]).collect()}
    near = {r.feature: r for r in aggregate.describe_approx(raw, ["MonthlyIncome"]).collect()}
    assert near["MonthlyIncome"].q50 == pytest.approx(exact["MonthlyIncome"].q50, rel=0.01)
