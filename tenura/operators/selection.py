"""Exact order statistics by radix refinement.

A value has a 64-bit key in its own order. One pass counts the values by the first bits of
their keys, finds the prefixes that hold the wanted ranks, and the next pass counts
only what has those prefixes, by more bits. A prefix with a single value needs no further
pass, so most columns end after one or two, and three passes see every bit. What is
shuffled is a count per task and prefix, never the values; a group that holds a third
of all rows is counted like any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura.operators.columns import long_form, without_nan
from tenura.session import settle

#: Bits of each pass: sign, exponent and 8 fraction bits first.
PASSES = (20, 20, 24)
_FRACTION = 2.0**52
_SMALLEST_NORMAL = 2.0**-1022


def with_ordered_key(df: DataFrame, value: str, name: str) -> DataFrame:
    """Adds a long in the order of the doubles, equal for equal ones only: their bits, negative below zero.

    Zeros of both signs are equal. NaN and null have no key.
    """
    v, size, power, step = (F.col(c) for c in (value, "_size", "_power", "_step"))
    # log2 may miss by one next to a power of two; powers of two are exact
    staged = (
        df.withColumn("_size", F.abs(v))
        .withColumn("_near", F.least(F.floor(F.log2("_size")).cast("double"), F.lit(1023.0)))
        .withColumn("_power", F.pow(F.lit(2.0), F.col("_near")))
        .withColumn("_step", F.when(size >= power * 2, 1.0).when(size < power, -1.0).otherwise(0.0))
    )
    scale = F.when(step == 1, power * 2).when(step == -1, power / 2).otherwise(power)
    normal = (F.col("_near") + step + 1023).cast("long") * F.lit(2**52) + ((size / scale - 1) * _FRACTION).cast("long")
    bits = (
        F.when(size == 0, F.lit(0).cast("long"))
        .when(size == float("inf"), F.lit(2047 * 2**52))
        .when(size < _SMALLEST_NORMAL, (size * 2.0**537 * 2.0**537).cast("long"))
        .otherwise(normal)
    )
    keyed = staged.withColumn("_bits", F.when(~F.isnan(v), bits))
    return keyed.withColumn(name, F.when(v < 0, -F.col("_bits")).otherwise(F.col("_bits"))).drop("_size", "_near", "_power", "_step", "_bits")


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def _ranks(probs: Sequence[float], total: Column) -> Column:
    """The different places, from 0, that the quantiles of ``total`` values stand on."""
    places = [F.lit(float(p)) * (total - 1) for p in probs]
    return F.array_distinct(F.array(*[end(place).cast("long") for place in places for end in (F.floor, F.ceil)]))


def _keyed(table: DataFrame, values: Sequence[str], by: Sequence[str]) -> DataFrame:
    long = long_form(table, values, keep=by)
    return with_ordered_key(long.filter(F.col("value").isNotNull()), "value", "_key")


def first_counts(table: DataFrame, values: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The first pass, written: _n, _low, _high, _mean and _spread of each (by, feature, _prefix)."""
    v, prefix = F.col("value"), F.shiftright("_key", 64 - PASSES[0])
    counted = _keyed(table, values, by).groupBy(*by, "feature", prefix.alias("_prefix")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(v).alias("_low"), F.max(v).alias("_high"), F.avg(v).alias("_mean"), F.var_pop(v).alias("_spread")
    )
    return settle(counted)


def moments(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """by, feature, n, mean, std, min, max from :func:`first_counts`; null where infinities leave none."""
    groups = [*by, "feature"]
    n, total = F.col("_n"), F.sum("_n").over(Window.partitionBy(*groups))
    # at most 2 ** 20 rows of a group
    centred = counts.withColumn("_whole", F.sum(F.col("_mean") * n).over(Window.partitionBy(*groups)) / total)
    off = F.col("_mean") - F.col("_whole")
    spread = F.sqrt(F.sum(n * F.col("_spread") + n * off * off) / F.nullif(F.sum(n) - 1, F.lit(0)))
    return centred.groupBy(*groups).agg(
        F.sum(n).alias("n"), without_nan(F.max("_whole")).alias("mean"), without_nan(spread).alias("std"),
        F.min("_low").alias("min"), F.max("_high").alias("max"),
    )


def order_statistics(table: DataFrame, values: Sequence[str], probs: Sequence[float], by: Sequence[str], first: DataFrame | None = None) -> DataFrame:
    """by, feature, _rank, _value, _total: the values at the places the quantiles need.

    Groups are joined null-safe and may be many: the state between passes is a table. A
    pass reads only the columns that are still open.
    """
    groups = [*by, "feature"]
    counts, within, shift = first or first_counts(table, values, by), groups, 64
    wanted = found = None
    for bits in PASSES:
        outer, shift = shift, shift - bits
        if wanted is not None:
            within = [*groups, "_outer"]
            # one row per column
            still = [r.feature for r in wanted.select("feature").distinct().collect()]
            rows = _keyed(table, still, by).withColumn("_outer", F.shiftright("_key", outer))
            rows = rows.join(wanted, null_safe(rows, wanted, within), "left_semi")
            counts = rows.groupBy(*within, F.shiftright("_key", shift).alias("_prefix")).agg(
                F.count(F.lit(1)).alias("_n"), F.min("value").alias("_low"), F.max("value").alias("_high")
            )
        # at most 2 ** bits rows
        whole = Window.partitionBy(*within)
        before = whole.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
        placed = counts.select(
            *within, "_prefix", "_n", "_low", "_high", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias("_whole")
        )
        if wanted is None:
            places = F.transform(_ranks(probs, F.col("_whole")), lambda r: F.struct(r.alias("rank"), r.alias("rest")))
            asked = placed.withColumn("_total", F.col("_whole")).withColumn("_places", places)
        else:
            asked = placed.join(wanted, null_safe(placed, wanted, within)).select(
                *[placed[c] for c in placed.columns], "_total", "_places"
            )
        here = lambda p: (p.rest >= F.col("_before")) & (p.rest < F.col("_before") + F.col("_n"))
        asked = asked.withColumn("_places", F.filter("_places", here)).filter(F.size("_places") > 0)
        inner = F.transform("_places", lambda p: F.struct(p.rank.alias("rank"), (p.rest - F.col("_before")).alias("rest")))
        asked = settle(asked.select(*groups, F.col("_prefix").alias("_outer"), "_low", "_high", "_total", inner.alias("_places")))
        single = F.col("_low") == F.col("_high")
        told = asked.filter(single).select(*groups, F.explode("_places.rank").alias("_rank"), F.col("_low").alias("_value"), "_total")
        found = told if found is None else found.unionByName(told)
        wanted = asked.filter(~single).select(*groups, "_outer", "_total", "_places")
        if wanted.isEmpty():
            break
    return found


def radix_quantiles(
    df: DataFrame, values: Sequence[str], probs: Mapping[str, float], by: Sequence[str] = (), settled: bool = False, first: DataFrame | None = None
) -> DataFrame:
    """by, feature, n and linear-interpolated quantiles: one row per group and column that has values.

    Null and NaN are no values; infinities are. ``settled`` says that ``df`` is a written
    table, which each pass may read; ``first`` is its :func:`first_counts` where they are known.
    """
    table = df if settled else settle(df.select(*by, *values))
    groups = [*by, "feature"]
    found = order_statistics(table, values, list(probs.values()), by, first)
    ends = []
    for name, p in probs.items():
        place = F.lit(float(p)) * (F.col("_total") - 1)
        for end, index in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            ends.append(F.max(F.when(F.col("_rank") == index, F.col("_value"))).alias(f"_{name}_{end}"))
    picked = found.groupBy(*groups).agg(F.max("_total").alias("n"), *ends)

    def between(name: str, p: float) -> Column:
        place = F.lit(float(p)) * (F.col("n") - 1)
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        return F.when(low == high, low).otherwise(low + (high - low) * (place - F.floor(place))).alias(name)

    return picked.select(*groups, "n", *[between(name, p) for name, p in probs.items()])
