"""Exact top-k by integer inner product with an impact-ordered index, a score at a time.

A dimension and a sign are a term, and a component is an impact: a query's positive
weights meet the components, its negative weights the negated ones, so all weights
count up. Impacts are quantised to levels of equal width, and the postings of a block
lie in segments by level, highest first. Segments are processed in that order over all
terms. At each step a vector's score lies between two bounds: a posting seen lies in
its level, one not yet seen lies below the level reached. Processing stops when few
vectors have an upper bound that reaches the k-th best exact score known; all others
are proven out, and those few are rescored exactly.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.llm.blocks import INDEX_ROWS, Index, against_all, best, usable_vectors

LEVELS = 32
#: Share of a block's vectors that may be left for exact rescoring when processing stops.
FEW = 0.01
_LONG = 2**63 - 1


def build_segments(ids: np.ndarray, values: np.ndarray) -> Index:
    """Postings (vector * terms + term) in segments of falling impact level."""
    n, width = values.shape
    top = max(1.0, float(np.abs(values).max(initial=0)))
    step = np.ceil(2 * top / LEVELS)
    terms = np.concatenate([values, -values], axis=1)
    level = np.clip(np.ceil((top - terms) / step), 1, None).astype(np.int64).reshape(-1)
    # a term at the very edge of a level belongs to the next: segments hold impacts above their lower edge
    level += (terms.reshape(-1) <= top - level * step)
    last = int(level.max(initial=1))
    order = np.argsort(level, kind="stable")
    ends = np.searchsorted(level[order], np.arange(1, last + 1), "right")
    return {
        "ids": ids.astype(np.int64).tobytes(), "values": values.tobytes(), "postings": order.astype(np.int64).tobytes(),
        "ends": ends.astype(np.int64).tobytes(), "edges": (top - step * np.arange(last + 1)).tobytes(),
    }


def integer_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of row pairs; beyond 64 bits they stay at the end of the range."""
    if not len(a):
        return np.zeros(0, np.int64)
    if np.abs(a).max() * np.abs(b).max() * a.shape[1] < 2**62:
        return np.einsum("pd,pd->p", a.astype(np.int64), b.astype(np.int64))
    whole = [sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for p, q in zip(a, b, strict=True)]
    return np.array([min(max(x, -_LONG - 1), _LONG) for x in whole], np.int64)


def searcher(k: int):
    def search(index: Index, query_ids: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = np.frombuffer(index["ids"], np.int64)
        n, width = len(ids), asked.shape[1]
        values = np.frombuffer(index["values"]).reshape(n, width)
        postings, ends, edges = (np.frombuffer(index[p], t) for p, t in (("postings", np.int64), ("ends", np.int64), ("edges", np.float64)))
        out = []
        for a in range(0, len(asked), 256):
            rows, part = query_ids[a : a + 256], asked[a : a + 256]
            weights = np.concatenate([np.maximum(part, 0), np.maximum(-part, 0)], axis=1)
            total = weights.sum(axis=1)
            # whole numbers below 2**24 are exact in single precision
            kind = np.float32 if 2 * np.abs(edges).max() * max(1.0, total.max()) < 2**24 else np.float64
            margin = 0.0 if kind == np.float32 else 1e-9 * np.abs(edges).max() * total
            weights = weights.astype(kind)
            seen = np.zeros((len(part), n), kind)
            gained = np.zeros((len(part), n), kind)
            own = rows[:, None] == ids
            start = 0
            for t in range(1, len(edges)):
                here = postings[start : ends[t - 1]]
                start = int(ends[t - 1])
                if len(here):
                    segment = np.zeros(n * 2 * width, kind)
                    segment[here] = 1
                    seen += weights @ segment.reshape(n, 2 * width).T
                gained += seen * kind(edges[t - 1] - edges[t])
                if t < len(edges) - 1 and t % 4:
                    continue
                upper = gained + (edges[t] * total + margin).astype(kind)[:, None]
                upper[own] = -np.inf
                if n > k + 1:
                    first = np.argpartition(-upper, k, axis=1)[:, :k]
                    known = integer_products(np.repeat(part, k, axis=0), values[first.reshape(-1)]).reshape(-1, k)
                    # where rows of the query's own id are among them, nothing is known of the k-th best
                    bar = np.where(np.take_along_axis(own, first, 1), -np.inf, known).min(axis=1)
                    bar -= np.abs(bar) * 1e-12
                else:
                    bar = np.full(len(part), -np.inf)
                possible = (upper >= bar[:, None]) & ~own
                if possible.sum() <= FEW * n * len(part):
                    break
            q, v = np.nonzero(possible)
            score = np.concatenate([integer_products(part[q[i : i + 65536]], values[v[i : i + 65536]]) for i in range(0, len(q), 65536)] or [np.zeros(0, np.int64)])
            kept = best(q, ids[v], score, k)
            out.append((rows[q[kept]], ids[v[kept]], score[kept]))
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))

    return search


def top_products(embeddings: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, index_rows: int = INDEX_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: for each query the ``k`` largest integer inner products, exactly.

    Components become floor(scale * x). A query never meets its own id; ties go to the
    smaller id; with fewer candidates all are returned. Zero vectors take part. Null
    ids or vectors and vectors with null or non-finite components don't; rows that
    repeat an id are candidates each, and ask together; vectors meet those of their own width. Scores beyond 64
    bits stay at the end of the range. An empty table gives no row; other columns are
    not read.
    """
    vectors = usable_vectors(embeddings, zero=True)
    whole = F.transform("embedding", lambda x: F.floor(x * scale).cast("double"))
    return against_all(vectors.withColumn("embedding", whole), is_query, build_segments, searcher(k), k, "long", index_rows)


def every_hundredth() -> Column:
    return F.pmod("vec_id", F.lit(100)) == 0
