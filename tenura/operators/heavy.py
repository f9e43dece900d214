"""Most frequent values, exactly, from heavy-hitter summaries.

Each task keeps a bounded number of counters per column (Misra and Gries): when they
run over, the first count beyond the bound is taken off all of them. What was taken off in all
tasks bounds how often a value without a counter can occur. The few candidates
that could be the most frequent are counted exactly in a second pass. If the best of
them occurs more often than that bound, no other value can equal it; if not, the column has no heavy value
and is counted in full.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenura.operators.columns import long_form, present
from tenura.session import settle

# the function travels with the plan: workers need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

COUNTERS = 256
_SUMMARY = "feature string, value string, kept long, missed long"


class Counters:
    """A Misra-Gries summary: each value occurred between its count and that plus ``missed`` times."""

    def __init__(self, most: int):
        self.most, self.missed, self.held = most, 0, {}

    def add(self, counts: dict[str, int]) -> None:
        held = self.held
        for value, n in counts.items():
            held[value] = held.get(value, 0) + n
        if len(held) > self.most:
            off = sorted(held.values(), reverse=True)[self.most]
            self.missed += off
            self.held = {value: n - off for value, n in held.items() if n > off}


def _summaries(df: DataFrame, columns: Sequence[str], counters: int) -> DataFrame:
    """Per task and column a row (value, kept) for each counter and one with ``missed``."""
    names = list(columns)

    def task(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Counters(counters) for _ in names]
        for frame in frames:
            for column, counts in zip(frame.columns, held, strict=True):
                found = pc.value_counts(column.drop_null())
                counts.add(dict(zip(found.field("values").to_pylist(), found.field("counts").to_pylist(), strict=True)))
        for name, counts in zip(names, held, strict=True):
            values = list(counts.held)
            yield pa.RecordBatch.from_pydict({
                "feature": pa.array([name] * (len(values) + 1), pa.string()), "value": pa.array([*values, None], pa.string()),
                "kept": pa.array([*counts.held.values(), None], pa.int64()), "missed": pa.array([None] * len(values) + [counts.missed], pa.int64()),
            })

    return df.mapInArrow(task, _SUMMARY)


def heavy_values(df: DataFrame, columns: Sequence[str], counters: int = COUNTERS) -> tuple[DataFrame, list[str]]:
    """(feature, value, n) of the values that may be a column's most frequent, ties included, and the columns without a heavy one.

    The shuffles carry counters and candidates, at most tasks x columns x ``counters`` rows; no
    other value of the table. Values are text; null and NaN are missing.
    """
    summaries = settle(_summaries(_texts(df, columns), columns, counters))
    missed = summaries.groupBy("feature").agg(F.coalesce(F.sum("missed"), F.lit(0)).alias("missed"))
    kept = summaries.filter(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.sum("kept").alias("kept"))
    # at most tasks x counters rows of a column
    best = F.max("kept").over(Window.partitionBy("feature"))
    candidates = settle(kept.join(missed, "feature").withColumn("best", best).filter("kept + missed >= best").select("feature", "value", "missed"))
    long = long_form(df, columns, dtype="string").filter(F.col("value").isNotNull())
    counted = settle(long.join(candidates, ["feature", "value"]).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"), F.max("missed").alias("missed")))
    # one row per column; a column without any value needs no more counting either
    proven = counted.groupBy("feature").agg(F.max("n").alias("n"), F.max("missed").alias("missed")).filter("n > missed")
    light = {r.feature for r in missed.filter("missed > 0").collect()} - {r.feature for r in proven.collect()}
    return counted.select("feature", "value", "n"), [c for c in columns if c in light]


def _texts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns side by side as text, NaN as null."""
    return df.select(*[present(df, c).cast("string").alias(c) for c in columns])


def most_frequent(df: DataFrame, columns: Sequence[str], counters: int = COUNTERS) -> DataFrame:
    """feature, value, n: candidates whose largest ``n`` is the column's mode, ties included."""
    heavy, light = heavy_values(df, columns, counters)
    if not light:
        return heavy
    rest = long_form(df, light, dtype="string").filter(F.col("value").isNotNull())
    return heavy.filter(~F.col("feature").isin(light)).unionByName(rest.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n")))
