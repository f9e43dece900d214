"""Exact copies by deterministic block naming.

A text is cut into blocks of a fixed size. Sorted, equal blocks lie side by side and get one
integer name; a text is then the sequence of its names. Adjacent names are paired,
and equal pairs get one name again, until each text has one. Names come from comparing
blocks and pairs themselves, never from hashes, so two texts of as many blocks have the
same last name if and only if they are equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenura.llm.common import arrow_schema, batch_of, text_batches
from tenura.session import scratch_path, settle

BLOCK_BYTES = 1024
#: Distinct blocks that a task holds to send each once; it starts anew beyond.
HELD_BYTES = 32_000_000
_SPACE = b" \t\n\x0b\x0c\r"
_ROW_BITS = 33
_SPELLED = "row long, id long, points long, digest binary, spelled array<long>, at long, block binary"


def without_space(text: bytes) -> bytes:
    """A UTF-8 text without spaces and code points 9 to 13."""
    return text.translate(None, _SPACE)


def _spell(docs: DataFrame, id_column: str, text_column: str, block_bytes: int, held_bytes: int) -> DataFrame:
    """Rows of texts (row, id, points, digest, spelled) and of distinct blocks (at, block), in one pass.

    ``spelled`` lists the text's blocks by their ``at``; a task sends a block once per
    ``held_bytes`` of distinct ones. Row and block numbers hold the task's number in
    their high bits; both kinds of rows are written together, so they agree whatever
    order the input comes in.
    """
    shape = arrow_schema(_SPELLED)

    def task(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << _ROW_BITS
        row = at = first
        held, size = {}, 0
        for frame in text_batches(frames, "text"):
            texts = frame.column("text").fill_null("")
            rows, new = [], []
            points = pc.utf8_length(texts).to_pylist()
            for key, n, text in zip(frame.column("id").to_pylist(), points, texts.cast(pa.binary()).to_pylist(), strict=True):
                plain = without_space(text)
                spelled = []
                for i in range(0, max(len(plain), 1), block_bytes):
                    block = plain[i : i + block_bytes]
                    name = held.get(block)
                    if name is None:
                        name = held[block] = at
                        new.append((None, None, None, None, None, at, block))
                        at, size = at + 1, size + len(block)
                    spelled.append(name)
                rows.append((row, key, n, hashlib.sha256(plain).digest(), spelled, None, None))
                row += 1
            yield batch_of(shape, rows + new)
            if size > held_bytes:
                held, size = {}, 0

    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(task, _SPELLED)


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` in the shared folder, pressed as far as Spark can."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def block_names(blocks: DataFrame) -> DataFrame:
    """at, name: equal blocks of (at, block) have one name, the smallest ``at`` of them.

    A row is a different block of a task, so a block that a third of all texts has is one row per task.
    """
    return blocks.select("at", F.min("at").over(Window.partitionBy("block")).alias("name"))


def paired(names: DataFrame) -> DataFrame:
    """row, length, place, name of the next level from those of (row, length, place, name).

    Neighbours are paired; the last name of an odd text has no partner, which no name stands for.
    Equal pairs are combined before their shuffle and numbered in sorted order.
    """
    even = F.col("place") % 2 == 0
    pairs = names.groupBy("row", "length", F.shiftright("place", 1).alias("half")).agg(
        F.max(F.when(even, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b")
    )
    # one partition has all equal pairs, so a place in its order is a name
    named = pairs.groupBy("a", "b").agg(F.lit(True).alias("there")).sortWithinPartitions("a", "b").select(
        "a", "b", F.monotonically_increasing_id().alias("name")
    )
    return pairs.join(named, ["a", "b"]).select("row", F.shiftright(F.col("length") + 1, 1).alias("length"), F.col("half").alias("place"), "name")


def identities(spelled: DataFrame, named_blocks: DataFrame) -> DataFrame:
    """row, level, name: one identity per text, the same for equal texts only.

    A text leaves once it has one name; a level has half the names of the one before
    and is written, so a lost executor costs one level.
    """
    places = spelled.select("row", F.size("spelled").cast("long").alias("length"), F.posexplode("spelled").alias("place", "at"))
    names = settle(places.join(named_blocks, "at").select("row", "length", F.col("place").cast("long").alias("place"), "name"))
    done, level = [], 0
    while True:
        done.append(names.filter("length = 1").select("row", F.lit(level).alias("level"), "name"))
        rest = names.filter("length > 1")
        if rest.isEmpty():
            break
        names, level = settle(paired(rest)), level + 1
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole


def exact_copies(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", block_bytes: int = BLOCK_BYTES, held_bytes: int = HELD_BYTES
) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 for each row of ``docs``.

    Texts are equal when they are after all spaces and code points 9 to 13 are deleted; a null text
    is empty, and all such texts are one group. Of each group the row of the most code
    points in its whole text stays, then that of the smallest id (null last), then one of them: rows that
    repeat an id each count, and exactly one row of a group is ``kept``. An empty table gives no
    rows. Other columns are not read.
    """
    spelled = _written(_spell(docs, id_column, text_column, block_bytes, held_bytes), "spelled")
    texts = spelled.filter(F.col("row").isNotNull())
    names = block_names(spelled.filter(F.col("at").isNotNull()))
    best = F.struct((-F.col("points")).alias("points"), F.col("id").isNull().alias("nameless"), "id", "row")
    known = settle(identities(texts, names).join(texts.select("row", "id", "points", "digest"), "row"))
    # written, so that Spark can split a group that a third of the rows are in
    groups = settle(known.groupBy("level", "name").agg(F.count(F.lit(1)).alias("group_size"), F.min(best).alias("best")))
    return known.join(groups, ["level", "name"]).select(
        F.col("id").alias("doc_id"), F.col("best.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options: int) -> DataFrame:
    """One row of each group of equal texts, with all columns of ``docs``; ids must be unique and not null."""
    kept = exact_copies(docs, id_column, text_column, **options).filter("kept").select(F.col("doc_id").alias(id_column))
    return docs.join(kept, id_column, "left_semi")
