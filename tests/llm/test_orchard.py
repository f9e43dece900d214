"""Clusters against plain rounds over all distances in whole numbers."""

import hashlib
import math
import random

import numpy as np
import pytest

from tenura.llm.orchard import Lists, cluster, integer_vectors, largest_component


def lloyd(rows, k, rounds, salt="3"):
    vectors = {key: [math.floor(1024 * x) for x in v] for key, v in rows}
    names = sorted(vectors, key=lambda key: hashlib.sha256(f"{salt}:{key}".encode()).hexdigest())
    centroids = [vectors[key] for key in names[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for v in vectors.values():
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(x) // len(x) for x in zip(*groups[i])] if i in groups else c for i, c in enumerate(centroids)]
    found = {key: nearest(v) for key, v in vectors.items()}
    inertia = {}
    for d, i in found.values():
        inertia[i] = inertia.get(i, 0) + d
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((key, i, d, inertia[i], sum(inertia.values()), digests[i]) for key, (d, i) in found.items())


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)


def told(df):
    return sorted(tuple(r)[:6] for r in df.collect())


@pytest.mark.parametrize("k,n,width", [(8, 300, 64), (5, 40, 3), (8, 3, 4), (1, 20, 2)])
def test_against_plain_rounds(spark, k, n, width):
    rng = random.Random(k * n)
    rows = [(i * 7, [np.float32(rng.gauss(i % 4, 0.5)).item() for _ in range(width)]) for i in range(n)]
    assert told(cluster(vectors_of(spark, rows), k=k, rounds=4, width=width)) == lloyd(rows, k, 4)


def test_ties_and_equal_vectors(spark):
    rng = random.Random(3)
    rows = [(i, [float(rng.randrange(3)), float(rng.randrange(2))]) for i in range(120)]
    assert told(cluster(vectors_of(spark, rows), k=8, rounds=3, width=2)) == lloyd(rows, 8, 3)


def test_rows_that_take_no_part(spark, clashing):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i), 1.0]) for i in range(10)]
    odd = [(20, None), (21, [1.0]), (22, [1.0, None]), (23, [nan, 1.0]), (24, [1.0, -inf]), (25, []), (26, [1.0, 2.0, 3.0])]
    df = clashing(vectors_of(spark, good + odd))
    assert told(cluster(df, k=3, width=2)) == lloyd(good, 3, 10)
    assert cluster(vectors_of(spark, odd), k=3, width=2).collect() == []
    assert cluster(vectors_of(spark, odd).filter("vec_id < 0"), k=3, width=2).collect() == []


def test_repeated_and_null_ids_are_rows(spark):
    df = vectors_of(spark, [(1, [0.0, 0.0]), (1, [9.0, 9.0]), (None, [5.0, 5.0]), (2, [0.0, 1.0])])
    rows = cluster(df, k=2, width=2).collect()
    assert len(rows) == 4 and sum(r.vec_id is None for r in rows) == 1


def test_components_that_overflow_raise(spark):
    with pytest.raises(Exception, match="would overflow"):
        integer_vectors(vectors_of(spark, [(1, [float(largest_component(2)), 0.0])]), 2).collect()


def test_search_is_exact_and_measures_few_distances():
    rng = np.random.default_rng(2)
    centers = rng.integers(-4000, 4000, (40, 8))
    vectors = centers[rng.integers(0, 40, 3000)] + rng.integers(-150, 150, (3000, 8))
    here, best, tried = Lists(centers).search(vectors)
    gaps = ((vectors[:, None] - centers[None]) ** 2).sum(2)
    assert (here == gaps.argmin(1)).all() and (best == gaps.min(1)).all()
    assert tried.mean() < 20 and tried.min() >= 1 and tried.max() <= 40


def test_search_stops_strictly_beyond_twice_the_distance():
    centers = np.array([[10, 0], [0, 0], [5, 1]])
    here, best, _ = Lists(centers).search(np.array([[5, 0], [0, 0]]))
    assert here.tolist() == [2, 1] and best.tolist() == [1, 0]
    here, best, _ = Lists(np.array([[10, 0], [0, 0]])).search(np.array([[5, 0]]))
    assert here.tolist() == [0] and best.tolist() == [25]  # a tie at exactly twice
