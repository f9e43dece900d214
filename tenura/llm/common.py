"""Arrow batches in and out of tasks, and files in the shared folder."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Characters that end a word, as the contracts state them: space and code points 9 to 13.
WORD = "[^\\x20\\x09-\\x0D]+"


def arrow_schema(ddl: str | StructType) -> pa.Schema:
    """The Arrow schema of a Spark schema."""
    return to_arrow_schema(StructType.fromDDL(ddl) if isinstance(ddl, str) else ddl)


def batch_of(schema: pa.Schema, rows: Sequence[Sequence[object]]) -> pa.RecordBatch:
    """A batch from row tuples in the order of ``schema``."""
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def text_batches(
    batches: Iterator[pa.RecordBatch], column: str, most: int = 8_000_000
) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that a piece holds about ``most`` bytes of ``column``, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            if i > start and total + size > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if len(sizes) > start:
            yield batch.slice(start)


def gathered(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> pa.Table:
    """All batches of a task; for steps whose partitions Spark keeps small."""
    held = list(batches)
    return pa.Table.from_batches(held) if held else schema.empty_table()


def set_apart(df: DataFrame, used: Sequence[str]) -> DataFrame:
    """``df`` with other names for columns whose names an operator uses itself; ``toDF`` gives the old ones back."""
    clashing = {u.lower() for u in used}
    taken = clashing | {c.lower() for c in df.columns}
    names = []
    for name in df.columns:
        if name.lower() in clashing:
            while name.lower() in taken:
                name += "_"
            taken.add(name.lower())
        names.append(name)
    return df if names == df.columns else df.toDF(*names)


def kind_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def same(left: Column, right: Column) -> Column:
    """Equality that also joins null with null."""
    return left.eqNullSafe(right)


def word_count(text: str | Column) -> Column:
    """Words of the whole text; a null text has none."""
    column = F.col(text) if isinstance(text, str) else text
    return F.regexp_count(F.coalesce(column, F.lit("")), F.lit(WORD)).cast("long")


def let_go(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of steps whose results are written: it does so once the driver's garbage is collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


class SharedFiles:
    """Files below one folder that the driver and all executors reach, on any store that Arrow knows."""

    def __init__(self, folder: str):
        from pyarrow import fs

        self.store, self.folder = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        self.store.create_dir(self.folder, recursive=True)

    def write(self, name: str, blocks: Iterator[bytes]) -> int:
        """Writes ``name`` whole or not at all; a repeated attempt replaces it with the same bytes."""
        attempt = f"{self.folder}/_attempt-{uuid.uuid4().hex}"
        size = 0
        with self.store.open_output_stream(attempt) as out:
            for block in blocks:
                size += len(block)
                out.write(block)
        self.store.move(attempt, f"{self.folder}/{name}")
        return size
