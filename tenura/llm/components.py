"""Connected components of a graph in a table."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import arrow_schema, batch_of
from tenura.session import settle

ROUNDS = 60


class Forest:
    """Union-find in which the smallest member is the root."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, a: int) -> int:
        parent = self.parent
        top = a
        while (up := parent.get(top, top)) != top:
            top = up
        while (up := parent.get(a, a)) != top:
            parent[a], a = top, up
        return top

    def unite(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def local_forest(edges: DataFrame) -> DataFrame:
    """Per task, edges from each node to the smallest node it reaches there; at most one per node."""
    columns = "a long, b long"
    shape = arrow_schema(columns)

    def task(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for frame in frames:
            for a, b in zip(frame.column("a").to_pylist(), frame.column("b").to_pylist(), strict=True):
                forest.unite(a, b)
        rows = [(forest.root(a), a) for a in list(forest.parent)]
        for i in range(0, len(rows), 100_000):
            yield batch_of(shape, rows[i : i + 100_000])

    return edges.mapInArrow(task, columns)


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) of every node that an edge touches.

    Large-star and small-star steps in turn: every neighbour is hung on the smallest
    node that its neighbour knows, until only stars are left. Each round is written,
    so a lost executor costs one step.
    """
    links = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b")
    links = settle(local_forest(links).distinct())
    before = None
    for _ in range(ROUNDS):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # large star: neighbours above a node go to the smallest around it
        large = both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").filter("a < b").distinct()
        large = settle(large)
        # small star: a node and its smaller neighbours go to the smallest of them
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b").select(F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y")).filter("x < y")
        links = settle(small.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
        after = links.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()
        if before == after:
            tops = links.select("a").distinct()
            return links.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
                tops.select(F.col("a").alias("node"), F.col("a").alias("root"))
            )
        before = after
    raise RuntimeError("components did not settle")
