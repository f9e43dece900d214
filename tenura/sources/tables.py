"""Layered tables in the session catalog."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession

from tenura.operators.columns import sanitize_columns
from tenura.operators.quality import Check, Observed, observations, observed_from
from tenura.sources.readers import scan_csv


class Lake:
    """Tables named ``layer.name``.

    ``root`` places the layers' folders (shared storage on a cluster); without it
    the session's warehouse is used. ``prefix`` keeps several lakes apart in one
    catalog. ``fmt`` may be ``delta`` where its jars are installed.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, prefix: str = "", fmt: str = "parquet"):
        self.spark, self.root, self.prefix, self.fmt = spark, root, prefix, fmt
        self._known: set[str] = set()

    def full_name(self, name: str) -> str:
        layer, table = name.split(".")
        return f"{self.prefix}{layer}.{table}"

    def create_schema(self, layer: str) -> None:
        where = f" LOCATION '{self.root}/{layer}'" if self.root else ""
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.prefix}{layer}{where}")
        self._known.add(layer)

    def write(self, df: DataFrame, name: str, mode: str = "overwrite",
              partition_by: Sequence[str] = ()) -> None:
        """Replace (or append to) a table; an overwrite replaces its schema too."""
        if name.split(".")[0] not in self._known:
            self.create_schema(name.split(".")[0])
        writer = df.write.mode(mode).format(self.fmt).option("overwriteSchema", mode == "overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(self.full_name(name))

    def write_observed(self, df: DataFrame, name: str, checks: Sequence[Check] = ()) -> Observed:
        """:meth:`write`, counting rows, a fingerprint and the failures of simple tests on the way."""
        metrics, decided = observations(df, checks)
        seen = Observation()
        self.write(df.observe(seen, *metrics), name)
        return observed_from(seen.get, decided)

    def bucketed(self, df: DataFrame, name: str, key: str, buckets: int) -> None:
        """Replace a table, laid out in ``buckets`` sorted buckets by ``key``.

        Tables of as many buckets are joined on their keys without an exchange, however large;
        choose a number that leaves a bucket small enough for a task.
        """
        if name.split(".")[0] not in self._known:
            self.create_schema(name.split(".")[0])
        placed = df.repartition(buckets, key)
        placed.write.mode("overwrite").format(self.fmt).bucketBy(buckets, key).sortBy(key).saveAsTable(self.full_name(name))

    def create_as(self, name: str, query: str) -> None:
        """CREATE OR REPLACE TABLE ... AS SELECT."""
        self.write(self.spark.sql(query), name)

    def create_view(self, df: DataFrame, name: str) -> None:
        """A session view, read as ``layer_name``."""
        df.createOrReplaceTempView(self.full_name(name).replace(".", "_"))

    def read(self, name: str) -> DataFrame:
        view = self.full_name(name).replace(".", "_")
        if not self.exists(name) and self.spark.catalog.tableExists(view):
            return self.spark.table(view)
        return self.spark.table(self.full_name(name))

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.full_name(name))

    def has_rows(self, name: str, rows: int) -> bool:
        """Whether a table exists with at least ``rows`` rows; stops counting there."""
        return self.exists(name) and self.read(name).limit(rows).count() >= rows

    def ingest(self, sources: Sequence[Mapping[str, str]]) -> DataFrame:
        """Load each ``{path, table[, schema]}`` CSV into its table and report on it."""
        report = []
        for item in sources:
            loaded = sanitize_columns(scan_csv(self.spark, item["path"], item.get("schema")))
            self.write(loaded, item["table"])
            written = self.read(item["table"])
            report.append((item["table"], written.count(), len(written.columns)))
        return self.spark.createDataFrame(report, "table_name string, n_rows bigint, n_columns bigint")
