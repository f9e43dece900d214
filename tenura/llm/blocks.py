"""A set of query vectors against all vectors, block by block."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura.llm.common import arrow_schema
from tenura.session import settle

INDEX_ROWS = 4096
QUERY_ROWS = 1024
#: Bytes of vectors in a block, as doubles; wide vectors lie in smaller blocks.
BLOCK_BYTES = 1 << 25
#: Blocks of queries that meet a block of vectors in one task.
MET_BLOCKS = 8
FOUND = "query_id long, vec_id long, score"

Index = dict[str, bytes]


def usable_vectors(embeddings: DataFrame, zero: bool) -> DataFrame:
    """vec_id, embedding (double) and width of the vectors that take part; ``zero`` keeps zero vectors.

    Null ids and vectors and those with null or non-finite components are out. Rows that
    repeat an id all stay.
    """
    vector = F.col("embedding").cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = embeddings.select("vec_id", vector.alias("embedding")).filter(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", finite)
    )
    if not zero:
        rows = rows.filter(F.exists("embedding", lambda x: x != 0))
    return rows.select(F.col("vec_id").cast("long"), "embedding", F.size("embedding").alias("width"))


def _sized(rows: DataFrame, block_rows: int, name: str) -> tuple[DataFrame, int, int]:
    """Rows with a block number, the number of blocks and the bytes of one; blocks are even, whatever the ids are, and hold about ``BLOCK_BYTES`` at most."""
    count, numbers = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("width"), F.lit(0))).first()
    n = max(1, -(-count // block_rows), -(-8 * numbers // BLOCK_BYTES))
    return rows.withColumn(name, F.pmod(F.monotonically_increasing_id(), F.lit(n))), n, 8 * numbers // n


def _blocks(rows: DataFrame, block_rows: int, name: str) -> tuple[DataFrame, int]:
    return _sized(rows, block_rows, name)[:2]


def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids in ascending order and the vectors, as doubles."""
    ids = table.column("vec_id").to_numpy()
    flat = table.column("embedding").combine_chunks().flatten()
    vectors = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(ids), -1)
    order = np.argsort(ids, kind="stable")
    return ids[order], vectors[order]


def against_all(
    vectors: DataFrame,
    is_query: Column,
    build: Callable[[np.ndarray, np.ndarray], Index],
    search: Callable[[Index, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]],
    k: int,
    score: str,
    index_rows: int = INDEX_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best of all vectors for each query.

    ``build`` makes the index of a block, ``search`` gives a block's best for a block
    of queries as (query ids, vector ids, scores), ``k`` for each query. Only vectors
    of the query's width meet it. A task holds one block of vectors, indexed there, and up to ``MET_BLOCKS``
    blocks of queries; both come by a shuffle, never through the driver, and no index is written. Each
    query keeps ``k`` rows of each block. Query rows that share an id ask together: its
    ``k`` best are those of all their products.
    """
    rows = settle(vectors)
    placed, n = _blocks(rows, index_rows, "block")
    asking, m, size = _sized(rows.filter(is_query), query_rows, "asked")
    together = max(1, min(MET_BLOCKS, BLOCK_BYTES // max(size, 1)))
    asked_columns = "width int, asked long, vec_ids binary, vectors binary"
    asked_shape = arrow_schema(asked_columns)

    def asked(key: tuple, table: pa.Table) -> pa.Table:
        ids, values = matrix(table)
        row = {"width": [key[0].as_py()], "asked": [key[1].as_py()], "vec_ids": [ids.tobytes()], "vectors": [values.tobytes()]}
        return pa.Table.from_pydict(row, schema=asked_shape)

    queries = settle(asking.groupBy("width", "asked").applyInArrow(asked, asked_columns))
    found_columns = f"{FOUND} {score}"
    found_shape = arrow_schema(found_columns)

    def met(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if len(left) and len(right):
            index = build(*matrix(left))
            for ids, values in zip(right.column("vec_ids"), right.column("vectors"), strict=True):
                ids = np.frombuffer(ids.as_py(), np.int64)
                found.append(search(index, ids, np.frombuffer(values.as_py(), np.float64).reshape(len(ids), -1)))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [[]] * len(found_shape)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, found_shape, strict=True)], schema=found_shape)

    # the queries go to each block of vectors, a block of vectors to every few blocks of queries
    key, last = ["width", "block", "part"], (m - 1) // together
    every = lambda most: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(most).cast("long")))
    side = queries.withColumn("part", F.floor(F.col("asked") / together)).withColumn("block", every(n - 1))
    tasks = min(n * (last + 1), 4096)
    found = placed.withColumn("part", every(last)).repartition(tasks, *key).groupBy(*key).cogroup(
        side.repartition(tasks, *key).groupBy(*key)
    ).applyInArrow(met, found_columns)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def best(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best of each row: larger scores first, ties to smaller ids."""
    order = np.lexsort((ids, -scores, rows))
    ordered = rows[order]
    first = np.searchsorted(ordered, ordered, "left")
    return order[np.arange(len(order)) - first < k]
