"""Radix selection, heavy hitters, digests, sketches and exact rank sums against plain forms."""

import math
import random
import struct
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from checks.common import all_cards
from tenura.functions.pvalues import rank_sum_tail, student_tail
from tenura.operators import aggregate, distinct, heavy, profile, ranking, selection, stats
from tenura.operators.digest import row_digest

INF, NAN = float("inf"), float("nan")


def test_keys_are_in_the_order_of_the_doubles(spark):
    rng = random.Random(4)
    values = [0.0, -0.0, 1.0, -1.0, INF, -INF, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, 0.1, 0.3, 1 / 3]
    values += [2.0**e * s for e in range(-1074, 1024, 7) for s in (1, 1 + 2**-52, 1 - 2**-53)]
    values += [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(3000)]
    values = [v for v in values if not math.isnan(v)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = selection.with_ordered_key(df, "v", "k").collect()

    def bits(v):
        plain = struct.unpack("<q", struct.pack("<d", abs(v)))[0]
        return -plain if v < 0 else plain

    assert [(r.v, r.k) for r in rows if r.k != bits(r.v)] == []


@pytest.mark.parametrize("n", [1, 2, 5, 1000])
def test_quantiles_of_any_doubles(spark, n):
    rng = random.Random(n)
    kinds = [lambda: rng.gauss(0, 1), lambda: rng.choice([1.0, 2.0, 1.0 + 2**-52]), lambda: 10.0 ** rng.uniform(-300, 300) * rng.choice([-1, 1]), lambda: float(rng.randrange(10**6))]
    rows = [(rng.choice(["a", "a", "b", None]), *[k() if rng.random() < 0.9 else rng.choice([None, NAN]) for k in kinds]) for _ in range(n)]
    df = spark.createDataFrame(rows, "g string, c0 double, c1 double, c2 double, c3 double").repartition(5)
    probs = {"a": 0.0, "b": 0.1, "m": 0.5, "z": 1.0}
    told = {(r.g, r.feature): r for r in selection.radix_quantiles(df, ["c0", "c1", "c2", "c3"], probs, by=["g"]).collect()}
    seen = 0
    for g in {r[0] for r in rows}:
        for i in range(4):
            values = [r[i + 1] for r in rows if r[0] == g and r[i + 1] is not None and not math.isnan(r[i + 1])]
            if values:
                seen += 1
                row = told[(g, f"c{i}")]
                assert row.n == len(values)
                for name, p in probs.items():
                    assert row[name] == pytest.approx(np.quantile(values, p), rel=1e-12)
    assert len(told) == seen


def test_describe_of_hot_odd_and_empty_columns(spark):
    rows = [(7.0 if i % 3 else float(i), NAN, None, INF if i == 5 else 1.0) for i in range(900)]
    df = spark.createDataFrame(rows, "hot double, nan double, none double, endless double").repartition(7)
    told = {r.feature: r for r in aggregate.describe(df, df.columns).collect()}
    values = [r[0] for r in rows]
    hot = told["hot"]
    assert (hot.n, hot.q50, hot.max) == (900, 7.0, max(values))
    assert hot["mean"] == pytest.approx(np.mean(values)) and hot["std"] == pytest.approx(np.std(values, ddof=1))
    assert told["nan"].n == told["none"].n == 0 and told["nan"]["mean"] is None and told["none"].q50 is None
    assert told["endless"].max == INF and told["endless"]["std"] is None and told["endless"].q75 == 1.0


def test_plans_shuffle_counts_not_values(spark):
    df = spark.range(200_000).select((F.col("id") * 0.37 + 1).alias("v"))
    counts = selection.first_counts(df, ["v"])
    assert counts.count() < 10_000


@pytest.mark.parametrize("counters", [2, 8, 256])
def test_modes_of_any_distribution(spark, counters):
    rng = random.Random(counters)
    rows = [(
        "hot" if rng.random() < 0.4 else f"t{rng.randrange(500)}", i, rng.choice([1, 2]), rng.choice([None, NAN, 2.5]), None, f"v{min(i % 40, 30)}",
    ) for i in range(2000)]
    df = spark.createDataFrame(rows, "hot string, key int, tie int, holes double, none string, light string").repartition(6)
    told = {r.feature: (r["mode"], r.n) for r in aggregate.column_modes(df, df.columns).collect()}
    for i, name in enumerate(df.columns):
        values = Counter(r[i] for r in rows if r[i] is not None and r[i] == r[i])
        if not values:
            assert name not in told
            continue
        most = max(values.values())
        best = min(v for v, n in values.items() if n == most)
        assert told[name] == (str(best), most)


def test_summaries_bound_what_they_miss():
    rng = random.Random(1)
    summary, true = heavy.Counters(10), Counter()
    for _ in range(50):
        batch = Counter(rng.choice(["a"] * 30 + [f"x{i}" for i in range(100)]) for _ in range(200))
        true += batch
        summary.add(batch)
        assert len(summary.held) <= 10
    for value, n in true.items():
        held = summary.held.get(value, 0)
        assert held <= n <= held + summary.missed


def test_only_candidates_are_counted_where_a_value_is_heavy(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.col("id").cast("string")).alias("c"))
    counted, light = heavy.heavy_values(df, ["c"])
    assert light == [] and [(r.value, r.n) for r in counted.collect()] == [("hot", 10_000)]


def test_typed_rows(spark):
    rows = spark.sql("""
        SELECT * FROM VALUES (0.0D, timestamp'2020-01-01 00:00:00.000001', 'a', array(1, null), named_struct('x', 1.5f, 'y', 'b'), map('k', 1, 'l', 2)),
          (-0.0D, timestamp'2020-01-01 00:00:00.000001', 'a', array(1, null), named_struct('x', 1.5f, 'y', 'b'), map('l', 2, 'k', 1)),
          (0.0D, timestamp'2020-01-01 00:00:00.000002', 'a', array(1, null), named_struct('x', 1.5f, 'y', 'b'), map('k', 1, 'l', 2)),
          (double('NaN'), timestamp'2020-01-01 00:00:00', '', array(), named_struct('x', float('NaN'), 'y', null), map()),
          (double('NaN'), timestamp'2020-01-01 00:00:00', '', array(), named_struct('x', float('NaN'), 'y', null), map()),
          (null, null, null, null, null, null), (null, null, 'null', null, null, null), (null, null, '-', null, null, null) t(a, b, c, d, e, f)""")
    assert aggregate.duplicate_rows(rows).first().duplicates == 2
    # neighbouring cells can't run into each other
    pair = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("1:a", ""), ("", "1:a")], "x string, y string")
    assert pair.select(row_digest(pair)).distinct().count() == 4
    nested = spark.sql("SELECT * FROM VALUES (array(array('a'), array('b'))), (array(array('a', 'b'))), (array(array('a'), array())) t(x)")
    assert aggregate.duplicate_rows(nested).first().duplicates == 0


def test_distinct_counts_and_profiles_of_odd_columns(spark):
    df = spark.sql("""SELECT id, CASE id % 4 WHEN 0 THEN 0.0D WHEN 1 THEN -0.0D WHEN 2 THEN double('NaN') END AS zero, map('a', id % 3) AS m,
        'x' AS one, CAST(NULL AS string) AS none, timestamp_micros(id % 5) AS at, CAST(CAST(id % 7 AS string) AS binary) AS b FROM range(100)""")
    counts = {r.feature: r.n_unique for r in distinct.distinct_counts(df, df.columns).collect()}
    assert counts == {"id": 100, "zero": 1, "m": 3, "one": 1, "none": 0, "at": 5, "b": 7}
    told = {r.column_name: r for r in profile.schema_profile(df, "id").collect()}
    assert (told["zero"].non_null, told["zero"].null_count, told["zero"].sample_value) == (50, 50, "0.0")
    assert told["one"].sample_value == "x" and told["none"].sample_value is None


def test_sketches_of_loads_merge(spark):
    df = spark.range(30_000).select(F.col("id"), (F.col("id") % 1000).alias("k"), F.lit(None).cast("double").alias("none"))
    loads = [distinct.column_sketches(df.filter(F.col("id") % 3 == i), df.columns, str(i)) for i in range(3)]
    merged = {r.feature: r for r in distinct.merged_profile(loads[0].unionByName(loads[1]).unionByName(loads[2])).collect()}
    for name, n in (("id", 30_000), ("k", 1000), ("none", 0)):
        assert abs(merged[name].n_unique - n) <= distinct.sketch_error() * n
    assert (merged["id"].n_rows, merged["id"].n_loads, merged["none"].null_count) == (30_000, 3, 30_000)


def test_constants_and_rare_halves(spark):
    df = spark.sql("SELECT id, 'c' AS one, CASE WHEN id = 3 THEN 'n' ELSE 'y' END AS rare, id % 2 = 0 AS even, CAST(NULL AS int) AS none FROM range(1000)")
    told = {r.column_name: (r.n_unique, r.reason, r["mode"]) for r in profile.drop_plan(df, 0.01, ["id"]).collect()}
    assert told == {"id": (1000, "id", "0"), "one": (1, "constant", "c"), "rare": (2, "near-constant", "y"), "none": (0, "constant", None)}


def test_exact_rank_sums_count_every_order():
    for m, n in [(1, 1), (2, 3), (3, 5), (4, 4), (5, 8)]:
        orders = Counter(sum(c) - m * (m - 1) // 2 for c in combinations(range(m + n), m))
        for u in range(m * n + 1):
            far = max(u, m * n - u)
            p = min(1, 2 * sum(k for x, k in orders.items() if x >= far) / math.comb(m + n, m))
            assert rank_sum_tail(u, m, n) == pytest.approx(p, rel=1e-12)


def test_rank_sums_of_small_samples(spark):
    rows = [(float(i), int(i < 3)) for i in range(10)] + [(NAN, 1), (None, 0)]
    tested = stats.mann_whitney(spark.createDataFrame(rows, "v double, f int"), "v", "f").first()
    assert (tested.u, tested.n_pos, tested.n_neg) == (0.0, 3, 7) and tested.p_value == pytest.approx(2 / 120)
    tied = stats.mann_whitney(spark.createDataFrame([*rows, (0.0, 0)], "v double, f int"), "v", "f").first()
    assert tied.p_value > 0.01


def test_tails_of_tiny_t():
    for t in (1e-170, 1e-200, 5e-324, -1e-300):
        assert student_tail(t, 10) == pytest.approx(1.0)


def test_infinity_leaves_no_correlation(spark):
    rows = [(float(i), INF if i == 4 else float(i * i), i % 2, None if i == 4 else float(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "a double, b double, f int, c double")
    told = {r.feature: r for r in stats.point_biserial(df, ["a", "b"], "f", 0.05).collect()}
    assert told["b"].correlation is None and told["b"].p_value is None and not told["b"].significant and told["a"].correlation is not None
    r = {(x.a, x.b): x.r for x in stats.pearson_matrix(df, ["a", "b", "c"]).collect()}
    assert r["a", "b"] is None and r["b", "b"] is None and r["a", "c"] == pytest.approx(1) and 0.9 < r["b", "c"] < 1


@pytest.mark.parametrize("small", [True, False])
def test_roc_points_in_line_are_left_out(spark, small):
    rng = random.Random(2)
    rows = [(g, rng.randrange(60) / 60, rng.randrange(2)) for g in ("a", "b") for _ in range(400)]
    rows += [("flat", s / 10, y) for s in range(10) for y in (0, 1, 1)]
    df = spark.createDataFrame(rows, "g string, s double, y int").repartition(5)
    whole, kept = ({g: sorted((-r.threshold, r.fpr, r.tpr) for r in points if r.g == g) for g in ("a", "b", "flat")}
                   for points in (ranking.roc_curve(df, "s", "y", ["g"], drop).collect() for drop in (False, True)))
    for g in whole:
        area = [sum((b[1] - a[1]) * (a[2] + b[2]) / 2 for a, b in zip(c, c[1:])) for c in (whole[g], kept[g])]
        assert area[0] == pytest.approx(area[1], rel=1e-12)
        assert set(kept[g]) <= set(whole[g])
        inner = [p for o, p, q in zip(whole[g][1:], whole[g][2:], whole[g][3:]) if abs((p[1] - o[1]) * (q[2] - p[2]) - (q[1] - p[1]) * (p[2] - o[2])) < 1e-12]
        assert not set(inner) & set(kept[g])
    assert len(kept["flat"]) == 3  # start, first and last threshold


def test_roc_curve_has_every_threshold(spark, sf_dir):
    rows = [("a", s / 10, y) for s in range(10) for y in (0, 1, 1)]
    df = spark.createDataFrame(rows, "g string, s double, y int")
    assert sorted(r.threshold for r in ranking.roc_curve(df, "s", "y", ["g"]).collect()) == [*(s / 10 for s in range(10)), INF]
    points = {name: {tuple(r) for r in queries()[name](spark, sf_dir).collect()} for name in ("roc_curve", "roc_curve_corners")}
    cards = all_cards(spark, sf_dir)
    assert len(points["roc_curve"]) == cards.select("model", "score").distinct().count() + cards.select("model").distinct().count()
    assert points["roc_curve_corners"] < points["roc_curve"]
