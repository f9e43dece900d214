"""Declarative data tests over tables, reported as rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenura.operators.joins import BROADCAST_ROWS, counted


@dataclass(frozen=True)
class Check:
    """One test. ``arg`` holds accepted values, (parent, key), or a row count."""

    table: str
    column: str
    test: str
    arg: tuple = ()


def not_null(table: str, *columns: str) -> list[Check]:
    return [Check(table, c, "not_null") for c in columns]


def unique(table: str, *columns: str) -> list[Check]:
    return [Check(table, c, "unique") for c in columns]


def accepted(table: str, column: str, *values: object) -> Check:
    return Check(table, column, "accepted_values", tuple(values))


def relationship(table: str, column: str, parent: str, key: str) -> Check:
    return Check(table, column, "relationships", (parent, key))


def min_rows(table: str, rows: int) -> Check:
    return Check(table, "*", "min_rows", (rows,))


def same_rows(table: str, as_table: str) -> Check:
    return Check(table, "*", "row_preservation", (as_table,))


# --- counted while a table is written -----------------------------------------------------

@dataclass(frozen=True)
class Observed:
    """What the write of a table counted: its rows, its fingerprint, and failures by (column, test, arg)."""

    rows: int
    fingerprint: str
    failures: Mapping[tuple, int]

    def of(self, check: Check) -> int | None:
        """Failures of a test, where the write can tell them."""
        if check.test == "min_rows":
            return max(check.arg[0] - self.rows, 0)
        return self.failures.get((check.column, check.test, check.arg))


def fingerprint_sum(df: DataFrame) -> Column:
    """Aggregate: a sum of row hashes, the same for the same rows in any order."""
    cells = [F.to_json(c) if isinstance(df.schema[c].dataType, T.MapType) else F.col(c) for c in df.columns]
    return F.coalesce(F.sum(F.xxhash64(*cells).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))


def fingerprint(df: DataFrame) -> str:
    """Rows and their order-free hash, by a scan."""
    row = df.agg(F.count(F.lit(1)), fingerprint_sum(df)).first()
    return f"{row[0]}:{row[1]}"


def observations(df: DataFrame, checks: Sequence[Check]) -> tuple[list[Column], list[Check]]:
    """Metrics for ``DataFrame.observe``, and the tests they decide: nulls, and lists where no value is outside.

    Only sums leave a task. A list that some value is outside of needs its distinct
    values, so that test is left to a scan when it fails.
    """
    mine = [c for c in checks if c.test in ("not_null", "accepted_values")]
    metrics = [F.count(F.lit(1)).alias("rows"), fingerprint_sum(df).alias("hash")]
    for i, check in enumerate(mine):
        column = F.col(check.column)
        bad = column.isNull() if check.test == "not_null" else ~column.isin(list(check.arg))
        metrics.append(F.count_if(bad).alias(f"c{i}"))
    return metrics, mine


def observed_from(counts: Mapping[str, object], decided: Sequence[Check]) -> Observed:
    failures = {
        (c.column, c.test, c.arg): int(counts[f"c{i}"])
        for i, c in enumerate(decided) if c.test == "not_null" or counts[f"c{i}"] == 0
    }
    return Observed(int(counts["rows"]), f"{counts['rows']}:{counts['hash']}", failures)


def _line(check: Check, failures) -> object:
    return F.struct(
        F.lit(check.table).alias("table_name"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.test).alias("test"),
        failures.cast("bigint").alias("failures"),
    )


def _one_pass(df: DataFrame, checks: Sequence[Check], tables: Mapping[str, DataFrame],
              small_parents: Mapping[int, DataFrame]) -> DataFrame:
    """Nulls, orphans of small parents and row counts: one scan for any number of tests."""
    rows, lines = df, []
    for i, check in enumerate(checks):
        column = F.col(check.column) if check.column != "*" else None
        if check.test == "not_null":
            lines.append(_line(check, F.count_if(column.isNull())))
        elif check.test == "relationships":
            parent, seen = f"_parent_{i}", f"_seen_{i}"
            keys = small_parents[id(check)].select(F.col("_parent").alias(parent), F.lit(True).alias(seen))
            rows = rows.join(F.broadcast(keys), F.col(check.column) == F.col(parent), "left")
            lines.append(_line(check, F.count_if(column.isNotNull() & F.col(seen).isNull())))
        elif check.test == "min_rows":
            lines.append(_line(check, F.greatest(F.lit(check.arg[0]) - F.count(F.lit(1)), F.lit(0))))
        elif check.test == "row_preservation":
            expected = tables[check.arg[0]].agg(F.count(F.lit(1))).scalar()
            lines.append(_line(check, F.abs(F.count(F.lit(1)) - F.max(expected))))
    return rows.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))


def _orphan_count(df: DataFrame, check: Check, keys: DataFrame) -> DataFrame:
    """Orphans of a large parent: rows per foreign key are counted before the join,
    so a key that many rows share crosses the shuffle once per task."""
    used = (
        df.filter(F.col(check.column).isNotNull())
        .groupBy(F.col(check.column).alias("_fk"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    lost = used.join(keys, F.col("_fk") == F.col("_parent"), "left_anti")
    return lost.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_f")).select(
        F.inline(F.array(_line(check, F.col("_f"))))
    )


def _outside_values(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Distinct values outside their lists, all columns in one scan; nulls pass."""
    cells = [
        F.when(
            ~F.col(c.column).isin(list(c.arg)),
            F.struct(F.lit(i).alias("at"), F.col(c.column).cast("string").alias("value")),
        )
        for i, c in enumerate(checks)
    ]
    outside = df.select(F.inline(F.array_compact(F.array(*cells)))).distinct()
    counted = [F.count_if(F.col("at") == i).alias(f"n{i}") for i in range(len(checks))]
    lines = [_line(c, F.col(f"n{i}")) for i, c in enumerate(checks)]
    return outside.agg(*counted).select(F.inline(F.array(*lines)))


def _repeated(df: DataFrame, check: Check) -> DataFrame:
    """Non-null values that occur more than once."""
    column = F.col(check.column)
    counted = df.filter(column.isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return counted.agg(F.count_if(F.col("_n") > 1).alias("_f")).select(
        F.inline(F.array(_line(check, F.col("_f"))))
    )


def _known(check: Check, observed: Mapping[str, Observed]) -> int | None:
    mine = observed.get(check.table)
    if check.test == "row_preservation":
        other = observed.get(check.arg[0])
        return abs(mine.rows - other.rows) if mine and other else None
    return mine.of(check) if mine else None


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check],
               max_parents: int = BROADCAST_ROWS, observed: Mapping[str, Observed] | None = None) -> DataFrame:
    """One row per test: table, column, test, failures, status.

    Per table: one scan for nulls, orphans and counts, one for accepted values,
    and one aggregate per unique key. Tests that ``observed`` decides, from the writes of
    the same tables, cost no scan.
    """
    reports = []
    known = [(c, n) for c in checks if (n := _known(c, observed or {})) is not None]
    if known:
        rows = [(c.table, c.column, c.test, n) for c, n in known]
        spark = next(iter(tables.values())).sparkSession
        reports.append(spark.createDataFrame(rows, "table_name string, column_name string, test string, failures bigint"))
    decided = {id(c) for c, _ in known}
    checks = [c for c in checks if id(c) not in decided]
    for name in dict.fromkeys(c.table for c in checks):
        df = tables[name]
        mine = [c for c in checks if c.table == name]
        small_parents, large_parents = {}, {}
        for check in (c for c in mine if c.test == "relationships"):
            parent, key = check.arg
            keys, small = counted(tables[parent].select(F.col(key).alias("_parent")).distinct(), max_parents)
            (small_parents if small else large_parents)[id(check)] = keys
        simple = [c for c in mine if c.test not in ("accepted_values", "unique") and id(c) not in large_parents]
        listed = [c for c in mine if c.test == "accepted_values"]
        if simple:
            reports.append(_one_pass(df, simple, tables, small_parents))
        if listed:
            reports.append(_outside_values(df, listed))
        reports.extend(_repeated(df, c) for c in mine if c.test == "unique")
        reports.extend(_orphan_count(df, c, large_parents[id(c)]) for c in mine if id(c) in large_parents)
    report = reduce(DataFrame.unionByName, reports)
    return report.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def require(report: DataFrame) -> None:
    """Raise when any test failed; the report has one row per test."""
    failed = report.filter(F.col("status") == "fail").collect()
    if failed:
        lines = [f"{r.table_name}.{r.column_name} {r.test}: {r.failures}" for r in failed]
        raise AssertionError("data tests failed:\n" + "\n".join(lines))
