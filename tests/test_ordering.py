"""Block-wise numbering, running totals and quantiles against their plain forms."""

import random

import duckdb
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tenura.operators import ordering
from tenura.operators.aggregate import box_stats, pivot_median


def skewed(spark, rows=4000, seed=1):
    """A third of the rows share one group and value; some groups and values are null."""
    rng = random.Random(seed)
    data = []
    for i in range(rows):
        hot = rng.random() < 0.35
        group = "hot" if hot else rng.choice(["a", "b", "c", None])
        value = 7.0 if hot and rng.random() < 0.5 else rng.choice([None, *range(40)])
        data.append((i, group, None if value is None else float(value), rng.randrange(2)))
    return spark.createDataFrame(data, "id int, g string, v double, f int").repartition(6)


def test_dense_key_equals_row_number(spark):
    df = skewed(spark)
    order = ["g", "v", "id"]
    out = ordering.dense_key(df, order, "k")
    plain = F.row_number().over(Window.orderBy(*order))
    assert out.withColumn("p", plain).filter("k <> p").count() == 0
    assert out.agg(F.min("k"), F.max("k"), F.countDistinct("k")).first() == (1, 4000, 4000)


@pytest.mark.parametrize("rows", [0, 1])
def test_dense_key_of_tiny_tables(spark, rows):
    df = spark.range(rows).withColumnRenamed("id", "a")
    assert [r.k for r in ordering.dense_key(df, ["a"], "k").collect()] == list(range(1, rows + 1))


def test_dense_key_breaks_ties_by_the_last_column_and_puts_nulls_first(spark):
    df = spark.createDataFrame([(3, "x"), (1, "x"), (2, None)], "id int, s string")
    out = ordering.dense_key(df, ["s", "id"], "k").orderBy("k")
    assert [r.id for r in out.collect()] == [2, 1, 3]


@pytest.mark.parametrize("small", [True, False])
def test_number_rows_in_either_form(spark, small):
    out = ordering.number_rows(spark.range(100), ["id"], "k", known_small=small)
    assert out.filter("k <> id + 1").count() == 0 and out.count() == 100


@pytest.mark.parametrize("within", [(), ("g",)])
def test_running_totals_in_blocks_equal_the_window(spark, within):
    counts = skewed(spark).groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"), F.sum("f").alias("p"))
    order = ["v"] if within else ["g", "v"]
    small = ordering.running_totals(counts, ["n", "p"], order, within, known_small=True)
    blocks = ordering.running_totals(counts, ["n", "p"], order, within)
    assert sorted(small.columns) == sorted(blocks.columns)
    names = small.columns
    assert sorted(map(str, small.collect())) == sorted(map(str, blocks.select(*names).collect()))


@pytest.mark.parametrize("small", [True, False])
def test_quantiles_equal_another_engine(spark, small):
    df = skewed(spark).cache()
    probs = {"q10": 0.1, "q25": 0.25, "q50": 0.5, "q99": 0.99}
    mine = ordering.exact_quantiles(df.filter("g is not null"), "v", probs, by=["g"], known_small=small)
    con = duckdb.connect()
    con.register("t", df.toPandas())
    theirs = con.execute(
        "SELECT g, " + ", ".join(f"quantile_cont(v, {p}) AS {n}" for n, p in probs.items())
        + " FROM (SELECT g, CASE WHEN isnan(v) THEN NULL ELSE v END AS v FROM t) WHERE g IS NOT NULL GROUP BY g"
    ).fetchall()
    rounded = [[(r[0], *[round(x, 9) for x in r[1:]]) for r in side] for side in (mine.collect(), theirs)]
    assert sorted(rounded[0]) == sorted(rounded[1])


def test_box_stats_and_median_pivot(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "x"), ("a", 3, "y"), ("a", 100, "y"), ("b", 5, "x")], "g string, v int, c string")
    box = {r.g: r for r in box_stats(df, "v", "g").collect()}
    assert (box["a"].q1, box["a"].median, box["a"].q3) == (1.75, 2.5, 27.25)
    assert (box["a"].whisker_low, box["a"].whisker_high, box["a"].outliers) == (1, 3, 1)
    assert box["b"].median == 5 and box["b"].outliers == 0
    wide = {r.g: r for r in pivot_median(df, "g", "c", {"x": "mx", "y": "my"}, "v").collect()}
    assert (wide["a"].mx, wide["a"].my) == (1.5, 51.5) and wide["b"].my is None
