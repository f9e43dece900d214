"""Reading files into DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def scan_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV with a header line. Without a schema, types are inferred (an extra pass).

    With a schema, columns are found by the names in the header, in any order and any
    case; a missing one raises, others are left out. A cell that its type can't hold
    raises when the row is read: :func:`rejects` counts such cells beforehand.
    """
    if not schema:
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    cells, wanted = _cells(spark, path, schema)
    return cells.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted])


def rejects(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """column_name, n_rejected: cells that are neither empty nor of the column's type."""
    cells, wanted = _cells(spark, path, schema)
    bad = cells.agg(*[
        F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name) for f in wanted
    ])
    return bad.unpivot([], [f.name for f in wanted], "column_name", "n_rejected")


def _cells(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, StructType]:
    """The columns of ``schema`` as text, trimmed, by their names in the header."""
    wanted = StructType.fromDDL(schema)
    raw = spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
    there = {c.strip().lower(): c for c in raw.columns}
    missing = [f.name for f in wanted if f.name.lower() not in there]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return raw.select(*[F.trim(raw[f"`{there[f.name.lower()]}`"]).alias(f.name) for f in wanted]), wanted


def scan_first_available(spark: SparkSession, paths: Sequence[str], schema: str | None = None) -> DataFrame:
    """The first path that can be read and holds a row; one row is probed, not all."""
    problems = []
    for path in paths:
        try:
            found = scan_csv(spark, path, schema)
            if found.limit(1).count():
                return found
            problems.append(f"{path}: no rows")
        except (PySparkException, ValueError) as error:
            problems.append(f"{path}: {error}")
    raise FileNotFoundError(
        "none of the source files could be read; upload the CSV to one of these paths:\n"
        + "\n".join(problems)
    )
