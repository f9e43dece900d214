"""Column functions on hand-computed values."""

import pytest
from pyspark.sql import functions as F

from tenura import specs
from tenura.functions import encode
from tenura.functions.arithmetic import percent, ratio
from tenura.operators import columns
from tenura.plans import features, silver, star


def values(spark, cells, dtype="int"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(cells)], f"i int, x {dtype}").orderBy("i")


def applied(df, column):
    return [r[0] for r in df.select(column.alias("y"), "i").orderBy("i").select("y").collect()]


@pytest.mark.parametrize("spec, cells, labels", [
    (specs.AGE_BAND, [24, 25, 34, 35, 44, 45, 54, 55, None],
     ["Under 25", "25-34", "25-34", "35-44", "35-44", "45-54", "45-54", "55+", "55+"]),
    (specs.TENURE_BAND_4, [0, 1, 2, 3, 5, 6, 10, 11],
     ["0-2 years"] * 3 + ["3-5 years"] * 2 + ["6-10 years"] * 2 + ["10+ years"]),
    (specs.TENURE_BAND_5, [0, 1, 2, 3, 5, 6, 10, 11],
     ["Less than 1 year"] + ["1-2 years"] * 2 + ["3-5 years"] * 2 + ["6-10 years"] * 2 + ["10+ years"]),
    (specs.DISTANCE_BAND, [4, 5, 10, 11, 20, 21],
     ["Very Close (<5 mi)", "Close (5-10 mi)", "Close (5-10 mi)", "Moderate (11-20 mi)",
      "Moderate (11-20 mi)", "Far (20+ mi)"]),
])
def test_bands(spark, spec, cells, labels):
    assert applied(values(spark, cells), encode.band("x", spec)) == labels


def test_income_bands_differ_only_in_labels(spark):
    df = values(spark, [2911, 2912, 4919, 4920, 8379, 8380])
    for spec in (specs.INCOME_BAND, specs.INCOME_BAND_NAMED):
        assert [x[:2] for x in applied(df, encode.band("x", spec))] == ["Q1", "Q2", "Q2", "Q3", "Q3", "Q4"]


def test_risk_tiers_close_on_the_right(spark):
    df = values(spark, [0.0, 0.30, 0.3001, 0.60, 0.6001, 1.0], "double")
    assert applied(df, encode.band("x", specs.RISK_TIER)) == ["Low", "Low", "Medium", "Medium", "High", "High"]


def test_band_refuses_bad_specs():
    with pytest.raises(ValueError):
        encode.Band([1, 2], ["a", "b"])
    with pytest.raises(ValueError):
        encode.Band([2, 1], ["a", "b", "c"])


def test_flags_and_ordinals(spark):
    df = values(spark, ["Yes", "No", None, "yes"], "string")
    assert applied(df, encode.binary_flag("x", "Yes")) == [1, 0, 0, 0]
    travel = values(spark, ["Non-Travel", "Travel_Rarely", "Travel_Frequently", "other", None], "string")
    assert applied(travel, encode.decode("x", specs.TRAVEL_ORDER)) == [0, 1, 2, None, None]
    assert applied(values(spark, [1, 3, None]), encode.threshold_flag("x", "<=", 2)) == [1, 0, 0]


def test_ratios_guard_zero(spark):
    df = spark.createDataFrame([(0, 1000, 0), (1, 1000, 3)], "i int, monthly_income int, total_working_years int")
    assert applied(df, ratio("monthly_income", "total_working_years", 1)) == [1000.0, 250.0]
    assert applied(df, F.round(ratio("monthly_income", "total_working_years"), 2)) == [None, 333.33]
    assert applied(df, percent("total_working_years", "total_working_years")) == [None, 100.0]


def test_sanitize_columns(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["a b", "c-d", "e=f", "g(h)"])
    assert columns.sanitize_columns(df).columns == ["a_b", "c_d", "e_f", "g_h_"]


@pytest.mark.parametrize("column", list(specs.DECODE_DEFAULTS))
def test_one_hot_and_back(spark, column):
    vocabulary, default = specs.ONE_HOT[column], specs.DECODE_DEFAULTS[column]
    levels = list(vocabulary.values())
    df = values(spark, [*levels, None], "string")
    hot = df.select("i", *encode.one_hot("x", vocabulary))
    assert applied(hot, encode.one_hot_decode(vocabulary, default)) == [*levels, default]
    one_each = hot.filter(F.col("i") < len(levels)).select(sum(F.col(c) for c in vocabulary).alias("n"))
    assert {r.n for r in one_each.collect()} == {1}


def test_clean_schema(raw):
    out = silver.clean(raw)
    assert out.columns == [*specs.CLEAN_COLUMNS, "employee_number"]
    assert len(silver.clean(raw, keep_key=False).columns) == 32
    types = dict(out.dtypes)
    assert types["attrition"] == types["business_travel_encoded"] == "int" and types["department"] == "string"


def test_wide_tables_have_the_documented_shape(clean):
    table = features.ml_features(clean)
    assert len(table.columns) == 78 and table.columns[0] == "attrition"
    assert table.columns[1:] == specs.FEATURE_COLUMNS
    fact = star.fact(clean)
    assert fact.columns == specs.FACT_COLUMNS and len(fact.columns) == 47
    keys = [r[0] for r in fact.select("employee_key").orderBy("employee_key").collect()]
    assert keys == list(range(1, clean.count() + 1))
    missing = fact.filter(" or ".join(f"{spec[0]} is null" for spec in star.DIMENSIONS.values()))
    assert missing.count() == 0


def test_select_by_type(raw):
    assert len(columns.numeric_columns(raw, specs.NUMERIC_EXCLUDED)) == 23
    assert len(columns.string_columns(raw, specs.CATEGORICAL_EXCLUDED)) == 7
