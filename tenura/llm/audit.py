"""What each filter of a chain removes, in every order of the filters, from one count per failing mask.

A document's mask says which filters it fails. In the lexicographic list of all orders,
those that begin with the same filters are one interval of Lehmer ranks. A mask is removed at a
step by the orders that begin with filters it passes, followed by one that it fails:
some intervals. Its count is added where an interval begins and taken off where it ends,
and a prefix sum over the ranks gives the totals of every order at once.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura.llm.common import WORD, arrow_schema

#: Most filters: 7 have 5,040 orders, 35,280 rows for each part.
MOST_FILTERS = 7
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
AUDIT = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)


def text_filters(text: str = "text") -> dict[str, Column]:
    """The failure conditions that a text alone decides; a null text counts as empty.

    A: under 200 words. B: under half of the words distinct. C: over 2 % capitals A-Z.
    D: any of the marks # $ % & * |.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.regexp_extract_all(whole, F.lit(WORD), F.lit(0))
    capitals = F.length(whole) - F.length(F.regexp_replace(whole, "[A-Z]+", ""))
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * capitals > 2 * F.length(whole),
        "D": whole.rlike("[#$%&*|]"),
    }


def failing_masks(
    docs: DataFrame, labels: DataFrame, filters: dict[str, Column] | None = None, part: str = "source",
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """part, mask, n, good, toxic: documents, and those labelled good or toxic, by the filters they fail.

    Bit i of a mask is the i-th filter's; the bit after them says that a smaller id has the
    same text. A null part is the empty string. A null id has no smaller one and is none;
    rows that repeat an id count each. A document is good (toxic) if any row
    of ``labels`` for its id has quality (toxic) 1. Texts are compared by SHA-256 and cross
    no shuffle; copies are combined before each, so a text of a third of all documents is one row per task and part.
    """
    filters = filters or text_filters(text_column)
    bits = sum((F.when(failed, F.lit(1 << i)).otherwise(F.lit(0)) for i, failed in enumerate(filters.values())), F.lit(0))
    whole = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(whole, 256)).alias("digest"), bits.alias("mask"),
    )
    each = rows.groupBy("id", "digest", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    marks = labels.select(F.col("doc_id").alias("id"), "quality", "toxic").groupBy("id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("long")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("long")).alias("toxic"),
    )
    counts = ("n", "good", "toxic")
    known = each.join(marks, "id", "left").select(
        "id", "digest", "part", "mask", "n", *[(F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic")]
    )
    copies = known.groupBy("digest", "part", "mask", F.col("id").isNull().alias("nameless")).agg(
        *[F.sum(c).alias(c) for c in counts], F.min(F.struct("id", *counts)).alias("first")
    )
    # one row per text, part and mask
    holder = F.min("first.id").over(Window.partitionBy("digest"))
    judged = copies.withColumn("holds", F.col("nameless") | (F.col("first.id") == holder))

    def stays(c: str) -> Column:
        return F.when(F.col("nameless"), F.col(c)).when(F.col("holds"), F.col(f"first.{c}")).otherwise(F.lit(0))

    copied = 1 << len(filters)
    split = judged.select("part", F.inline(F.array(
        F.struct(F.col("mask"), *[stays(c).alias(c) for c in counts]),
        F.struct((F.col("mask") + copied).alias("mask"), *[(F.col(c) - stays(c)).alias(c) for c in counts]),
    )))
    # a part keeps its row of zeros where no mask of it has documents
    return split.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in counts])


@lru_cache(maxsize=MOST_FILTERS)
def intervals(n_filters: int) -> list[tuple[int, int, int, int]]:
    """(prefix mask before, filter, first rank, end rank) of every beginning of an order of filters."""
    out = []

    def walk(used: int, rank: int, step: int) -> None:
        each = factorial(n_filters - step - 1)
        for i in range(n_filters):
            if not used >> i & 1:
                out.append((used, i, rank, rank + each))
                if step + 1 < n_filters:
                    walk(used | 1 << i, rank, step + 1)
                rank += each

    walk(0, 0, 0)
    return out


def order_totals(counts: dict[int, tuple[int, int, int]], n_filters: int) -> np.ndarray:
    """COUNTS by (order, step, count) for one part; ``counts`` has (n, good, toxic) by mask."""
    n_orders = factorial(n_filters)
    removed, redundant, unique, good, toxic = ends = np.zeros((5, n_filters, n_orders + 1), np.int64)
    for mask, (n, n_good, n_toxic) in counts.items():
        for before, i, begin, end in intervals(n_filters):
            if not mask >> i & 1:
                continue
            step = before.bit_count()
            marks = [(redundant, n)] if mask & before else [(removed, n), (good, n_good), (toxic, n_toxic)]
            if mask == 1 << i:
                marks.append((unique, n))
            for array, amount in marks:
                array[step, begin] += amount
                array[step, end] -= amount
    removed, redundant, unique, good, toxic = np.cumsum(ends, axis=2)[:, :, :n_orders].transpose(0, 2, 1)
    whole = sum(n for n, _, _ in counts.values())
    kept = whole - np.cumsum(removed, axis=1)
    orders = np.array(list(permutations(range(n_filters))))
    of_filter = np.array([removed[orders == i].sum() for i in range(n_filters)])
    return np.stack([kept, removed, redundant, unique, good, toxic, of_filter[orders]], axis=2)


def audit_orders(masks: DataFrame, letters: str) -> DataFrame:
    """One row per part, order of the filters and step (AUDIT), zeros included, from (part, mask, n, good, toxic).

    A part has at most two rows to the power of the filters, so a task never gathers more.
    """
    if not 1 <= len(letters) <= MOST_FILTERS:
        raise ValueError(f"from 1 to {MOST_FILTERS} filters")
    shape = arrow_schema(AUDIT)
    names = ["".join(letters[i] for i in order) for order in permutations(range(len(letters)))]

    def part(key: tuple, table: pa.Table) -> pa.Table:
        rows = zip(*[table.column(c).to_pylist() for c in ("mask", "n", "good", "toxic")], strict=True)
        totals = order_totals({mask: counts for mask, *counts in rows}, len(letters))
        n_orders, n_steps, _ = totals.shape
        columns = [
            [key[0].as_py()] * (n_orders * n_steps), np.repeat(names, n_steps).tolist(), np.tile(np.arange(1, n_steps + 1), n_orders),
            *totals.reshape(-1, len(COUNTS)).T,
        ]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, shape, strict=True)], schema=shape)

    return masks.groupBy("part").applyInArrow(part, AUDIT)


def filter_audit(docs: DataFrame, labels: DataFrame, **options: object) -> DataFrame:
    """Filters A to D of :func:`text_filters` and E (copy of a smaller id) over ``docs``, in all 120 orders.

    kept: left after the step; removed: by the step; redundant: failing its filter but
    removed before; unique_fails: failing no other; good_lost and toxic_lost: removed
    ones with such labels; shapley: what its filter removes over all orders. An empty table gives no rows.
    """
    return audit_orders(failing_masks(docs, labels, **options), "ABCDE")
