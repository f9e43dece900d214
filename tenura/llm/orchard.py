"""Integer centroids by Lloyd's rounds; each vector finds its centroid by Orchard's search.

Every centroid has a list of the others, nearest first. A vector starts at one
centroid and walks its list; whenever it finds a closer one it jumps to that one's list
from its beginning. Centroids that it has met are marked and not measured again. It stops where the list is
strictly beyond twice its current distance: by the triangle inequality all further
centroids are farther than the current one, and one at exactly twice might tie.
Distances are squared integers, so each comparison is exact.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import arrow_schema
from tenura.session import settle

WIDTH, CENTROIDS, ROUNDS, SCALE, SALT = 64, 8, 10, 1024, "3"
#: Most centroids: the lists of a task hold their square, 268 MB at this number.
MOST_CENTROIDS = 4096
RESULT = "vec_id long, cluster int, distance long, tried int"


def largest_component(width: int) -> int:
    """Components below this leave four squared distances within a long."""
    return math.isqrt(2**59 // width)


def integer_vectors(embeddings: DataFrame, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """vec_id and vector (integers ``floor(scale * x)``) of the rows of exactly ``width`` finite components.

    All other rows take no part; each row of a repeated id stands for itself. A component
    that would overflow the squared distances raises.
    """
    scaled = F.transform(F.col("embedding"), lambda x: x.cast("double") * scale)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding")).filter(
        F.col("embedding").isNotNull() & (F.size("embedding") == width) & F.forall(F.col("embedding").cast("array<double>"), finite)
    )
    most = largest_component(width)
    fits = F.forall("scaled", lambda x: F.abs(x) < most)
    whole = F.transform("scaled", lambda x: F.floor(x).cast("int"))
    return rows.select("vec_id", scaled.alias("scaled")).select(
        "vec_id", F.when(fits, whole).otherwise(F.raise_error(F.lit(f"a component of {most} or more would overflow"))).alias("vector")
    )


def first_centroids(vectors: DataFrame, k: int = CENTROIDS, salt: str = SALT) -> np.ndarray:
    """The ``k`` vectors (all, if fewer) with the smallest SHA-256 of ``salt:vec_id``, in that order.

    Rows without an id come last; equal ids go by their components.
    """
    name = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.select(name.alias("name"), "vector").orderBy(F.asc_nulls_last("name"), "vector").limit(k).collect()
    return np.array([r.vector for r in rows], np.int64)


class Lists:
    """Neighbour lists of centroids, and the search over them."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        k = len(centroids)
        self.order = np.zeros((k, max(k - 1, 1)), np.int32)
        self.gaps = np.zeros((k, max(k - 1, 1)), np.int64)
        for c in range(k):
            gaps = squared(centroids - centroids[c])
            near = np.argsort(gaps, kind="stable")
            near = near[near != c]
            self.order[c, : k - 1], self.gaps[c, : k - 1] = near, gaps[near]
        lengths = np.sqrt(squared(centroids).astype(np.float64))
        self.by_length = np.argsort(lengths, kind="stable")
        self.lengths = lengths[self.by_length]

    def start(self, vectors: np.ndarray) -> np.ndarray:
        """For each vector the centroid of the nearest length: a guess that costs no distance."""
        length = np.sqrt(squared(vectors).astype(np.float64))
        right = np.searchsorted(self.lengths, length).clip(0, len(self.lengths) - 1)
        left = (right - 1).clip(0)
        nearer = np.where(length - self.lengths[left] <= self.lengths[right] - length, left, right)
        return self.by_length[nearer]

    def search(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest centroid (ties: smaller number), squared distance, and distances measured, for each vector.

        All vectors step through their own lists at once; only those that meet an
        unmarked centroid measure a distance in a step.
        """
        n, k = len(vectors), len(self.centroids)
        here = self.start(vectors).astype(np.int64)
        best = squared(vectors - self.centroids[here])
        marked = np.zeros((n, k), bool)
        marked[np.arange(n), here] = True
        place, tried = np.zeros(n, np.int64), np.ones(n, np.int32)
        walking = np.arange(n) if k > 1 else np.zeros(0, np.int64)
        while len(walking):
            within = self.gaps[here[walking], place[walking]] <= 4 * best[walking]
            walking = walking[within]
            met = self.order[here[walking], place[walking]]
            place[walking] += 1
            fresh = ~marked[walking, met]
            asking, met = walking[fresh], met[fresh]
            marked[asking, met] = True
            tried[asking] += 1
            far = squared(vectors[asking] - self.centroids[met])
            closer = (far < best[asking]) | ((far == best[asking]) & (met < here[asking]))
            jumping = asking[closer]
            here[jumping], best[jumping], place[jumping] = met[closer], far[closer], 0
            walking = walking[place[walking] < k - 1]
        return here, best, tried


def squared(rows: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", rows, rows)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _sums(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """cluster, place, total, n: sums over the vectors of each cluster, by component."""
    k, width = centroids.shape
    columns = "cluster int, n long, totals array<long>"
    shape = arrow_schema(columns)

    def task(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(centroids)
        totals, counts = np.zeros((k, width), np.int64), np.zeros(k, np.int64)
        for frame in frames:
            rows = _matrix(frame.column("vector"), width)
            if len(rows):
                cluster = lists.search(rows)[0]
                order = np.argsort(cluster, kind="stable")
                present, at = np.unique(cluster[order], return_index=True)
                totals[present] += np.add.reduceat(rows[order], at, axis=0)
                counts += np.bincount(cluster, minlength=k)
        there = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(there, pa.int32()), pa.array(counts[there]), pa.array(list(totals[there]), shape.field("totals").type)], schema=shape
        )

    parts = vectors.select("vector").mapInArrow(task, columns)
    cells = parts.select("cluster", "n", F.posexplode("totals").alias("place", "total"))
    return cells.groupBy("cluster", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floor of each cluster's mean; those of empty clusters stay.

    Each task sends one row per cluster; the driver gets centroids x components numbers.
    """
    after = centroids.copy()
    for row in _sums(vectors, centroids).collect():
        after[row.cluster, row.place] = row.total // row.n
    return after


def cluster(
    embeddings: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE, salt: str = SALT
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 and tried for each vector that takes part.

    Centroids start as the ``k`` vectors of the smallest hashes, move ``rounds`` times to the
    floored means of their vectors, and take the vectors once more. ``distance`` is squared;
    ``tried`` counts the distances that the search measured. Vectors that are null, of another
    width, or hold null or non-finite components take no part; an empty table gives no rows;
    with fewer vectors than ``k`` there are fewer centroids, and of equal ones the smaller number
    takes all. Other columns are not read. Vectors are written once as integers
    and read in each round; only sums leave a task, so no group is gathered.
    """
    if not 1 <= k <= MOST_CENTROIDS:
        raise ValueError(f"from 1 to {MOST_CENTROIDS} centroids")
    spark = embeddings.sparkSession
    vectors = settle(integer_vectors(embeddings, width, scale))
    centroids = first_centroids(vectors, k, salt).reshape(-1, width)
    for _ in range(rounds if len(centroids) else 0):
        after = moved(vectors, centroids)
        if (after == centroids).all():
            break  # further rounds would not move them either
        centroids = after
    shape = arrow_schema(RESULT)

    def task(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(centroids)
        for frame in frames:
            if len(frame):
                found = lists.search(_matrix(frame.column("vector"), width))
                columns = [frame.column("vec_id"), *found]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, shape, strict=True)], schema=shape)

    assigned = settle(vectors.mapInArrow(task, RESULT))
    digests = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids.tolist())]
    named = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")
    inertias = assigned.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    whole = assigned.agg(F.sum("distance").alias("inertia"))
    # one row per centroid
    told = inertias.join(F.broadcast(named), "cluster").withColumn("inertia", whole.scalar())
    return assigned.join(F.broadcast(told), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "tried"
    )
