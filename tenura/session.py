"""Session settings and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and laptops; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tenura")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Settings that matter for wide tables at any size.

    The JVM never compiles a method beyond 8000 bytes, so one fused stage over
    dozens of expressions would run interpreted; smaller units are compiled.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may go without: it gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="tenura-")
    spark.conf.set("spark.checkpoint.dir", made)
    spark.sparkContext.setCheckpointDir(made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


_scope: ContextVar[str | None] = ContextVar("scratch scope", default=None)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove what :func:`settle` writes inside the block once the block is left.

    For jobs whose results are tables: nothing settled may be read afterwards. The
    scope belongs to the calling context: other builds of the application don't see it,
    and threads that work for this one must be started in a copy of its context.
    """
    path = scratch_path(spark, "scope")
    token = _scope.set(path)
    try:
        yield
    finally:
        _scope.reset(token)
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table.

    Survives lost executors, keeps columns prunable, and gives later plans real
    sizes, so Spark picks its join strategy from what is there.
    """
    spark = df.sparkSession
    scope = _scope.get()
    path = f"{scope}/{uuid.uuid4().hex}" if scope else scratch_path(spark, "settled")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
