"""Nearest neighbours by inner product with randomly rotated one-bit codes.

A block of vectors is centred, each rest is scaled to length one, rotated at random
and kept as one sign bit a dimension. Two correction scalars a vector, its rest's
length and the rest's product with its own code, turn the product of code and rotated
query into an unbiased estimate whose error has a known spread. Vectors whose estimate
plus ``spread`` times that reaches the k-th best exact score found so far are rescored on the
original values, so the codes only decide what is left out. The rows that set this bar are
always rescored themselves, so a block gives ``k`` rows if it has them.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.llm.blocks import Index, against_all, best, usable_vectors

#: Standard deviations of the estimate's error that are allowed for.
SPREAD = 1.9
INDEX_ROWS = 16384


@lru_cache(maxsize=4)
def rotation(width: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, width)))
    return q * np.sign(np.diag(r))


def build_codes(ids: np.ndarray, vectors: np.ndarray) -> Index:
    """Packed sign bits and correction scalars of a block."""
    width = vectors.shape[1]
    centre = vectors.mean(axis=0)
    rest = vectors - centre
    length = np.sqrt((rest * rest).sum(axis=1))
    turned = (rest / np.where(length > 0, length, 1)[:, None]) @ rotation(width)
    own = np.abs(turned).sum(axis=1) / np.sqrt(width)
    return {
        "ids": ids.astype(np.int64).tobytes(), "vectors": vectors.tobytes(), "centre": centre.tobytes(),
        "bits": np.packbits(turned > 0, axis=1).tobytes(), "length": length.tobytes(), "own": own.tobytes(),
    }


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner product of each row pair, summed in the order of the components."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total += a[:, j] * b[:, j]
    return total


def estimates(index: Index, asked: np.ndarray, spread: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products, and each vector's error bound for a query of length one."""
    width = asked.shape[1]
    length, own = np.frombuffer(index["length"]), np.frombuffer(index["own"])
    packed = np.frombuffer(index["bits"], np.uint8).reshape(len(length), -1)
    signs = np.unpackbits(packed, axis=1, count=width).astype(np.float32) * 2 - 1
    turned = asked @ rotation(width)
    scale = length / np.where(own > 0, own, 1) / np.sqrt(width)
    centre = asked @ np.frombuffer(index["centre"])
    near = (turned.astype(np.float32) @ signs.T) * scale.astype(np.float32) + centre.astype(np.float32)[:, None]
    miss = np.sqrt(np.maximum(1 - own**2, 0)) / np.where(own > 0, own, 1) / np.sqrt(max(width - 1, 1e-9)) * length * spread
    # single precision rounds; its share of the lengths is added
    rounding = 1e-5 * (length + np.sqrt((np.frombuffer(index["centre"]) ** 2).sum()))
    return near, (miss + rounding).astype(np.float32)


def searcher(k: int, spread: float):
    def search(index: Index, query_ids: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = np.frombuffer(index["ids"], np.int64)
        vectors = np.frombuffer(index["vectors"]).reshape(len(ids), -1)
        longest = np.sqrt((vectors * vectors).sum(axis=1).max())
        out = []
        for a in range(0, len(asked), 256):
            rows, part = query_ids[a : a + 256], asked[a : a + 256]
            near, miss = estimates(index, part, spread)
            other = rows[:, None] != ids
            near[~other] = -np.inf
            size = np.sqrt((part * part).sum(axis=1))
            if len(ids) > 4 * k:  # exact scores of the best estimates set the bar
                first = np.argpartition(-near, 4 * k, axis=1)[:, : 4 * k]
                exact = np.einsum("qd,qkd->qk", part, vectors[first])
                exact[np.isneginf(np.take_along_axis(near, first, 1))] = -np.inf
                bar = -np.partition(-exact, k - 1, axis=1)[:, k - 1]
                bar -= 1e-9 * (1 + np.abs(bar)) + 1e-12 * size * longest
                # these rows count whatever their bounds say, and so do all that share the last of their estimates: copies
                last = np.take_along_axis(near, first, 1).min(axis=1) - 1e-6 * size * longest
                possible = near >= last[:, None]
                np.put_along_axis(possible, first, True, axis=1)
                possible |= near + size.astype(np.float32)[:, None] * miss >= bar.astype(np.float32)[:, None]
            else:
                bar = np.full(len(part), -np.inf)
                possible = np.ones(near.shape, bool)
            possible &= other
            q, v = [], []
            for i in range(len(part)):
                some = np.flatnonzero(possible[i])
                # the k best all reach the bar, which leaves room for rounding
                some = some[vectors[some] @ part[i] >= bar[i]]
                q.append(np.full(len(some), i))
                v.append(some)
            q, v = np.concatenate(q), np.concatenate(v)
            exact = products(part[q], vectors[v])
            kept = best(q, ids[v], exact, k)
            out.append((rows[q[kept]], ids[v[kept]], exact[kept]))
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))

    return search


def nearest(
    embeddings: DataFrame, is_query: Column, k: int = 20, spread: float = SPREAD, index_rows: int = INDEX_ROWS
) -> DataFrame:
    """query_id, rank, vec_id, score: for each query the ``k`` rows with the largest inner product found.

    Scores are exact, in double precision; a query never finds its own id; ties go to
    the smaller id; a query with fewer candidates gets all. Zero vectors, null ids or
    vectors and vectors with null or non-finite components take no part; rows that
    repeat an id are candidates each, and ask together; vectors meet those of their own width. A larger ``spread``
    rescores more and misses less. An empty table gives no row; other columns are not
    read.
    """
    vectors = usable_vectors(embeddings, zero=False)
    return against_all(vectors, is_query, build_codes, searcher(k, spread), k, "double", index_rows)


def every_twentieth() -> Column:
    return F.pmod("vec_id", F.lit(20)) == 0
