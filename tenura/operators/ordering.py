"""Row numbers, running totals and exact quantiles without one-task sorts.

A window over a whole table, or over one hot group, would pull all of it into a
single task. Here the table is range-partitioned on its sort key, each block
works alone, and only the per-block totals (one row per block) are combined. The plain
window is for callers that have counted their table already.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura.operators.columns import present
from tenura.session import settle

_ROW_BITS = 33  # monotonically_increasing_id keeps the row position in its low bits


def _order(columns: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in columns]


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def dense_key(df: DataFrame, order: Sequence[str | Column], name: str, settled: bool = False) -> DataFrame:
    """Number all rows 1..n in ``order``, with no global window.

    Equals ``row_number() over (order by ...)`` when ``order`` ends in a unique
    column. The rows are written before their order is sampled, so that what made them runs
    once. The numbered layout is written, too, so that counting the blocks and
    using them see the same rows even if executors are lost in between. ``settled`` says that
    ``df`` is a written table already.
    """
    keys = _order(order)
    laid_out = settle(
        (df if settled else settle(df)).repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    block = F.shiftright("_at", _ROW_BITS)
    position = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    # one row per block, so both the window and the broadcast are bounded by the
    # number of shuffle partitions
    offsets = (
        laid_out.groupBy(block.alias("_block"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_block", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    return (
        laid_out.withColumn("_block", block)
        .join(F.broadcast(offsets), "_block")
        .withColumn(name, F.col("_offset") + position + F.lit(1).cast("bigint"))
        .drop("_block", "_at", "_offset")
    )


def number_rows(
    df: DataFrame, order: Sequence[str | Column], name: str, known_small: bool = False
) -> DataFrame:
    """Row numbers 1..n in ``order``; by a plain window where the caller has counted the rows to be few."""
    if not known_small:
        return dense_key(df, order, name)
    number = F.row_number().over(Window.orderBy(*_order(order)))
    return df.withColumn(name, number.cast("bigint"))


def running_totals(
    df: DataFrame,
    sums: Sequence[str],
    order: Sequence[str | Column],
    within: Sequence[str] = (),
    known_small: bool = False,
    settled: bool = False,
    ahead: bool = False,
) -> DataFrame:
    """Adds ``<sum>_before`` (over earlier rows of the group) and ``<sum>_total``.

    ``ahead`` adds ``<sum>_next``, that of the row which follows in the group (null after the
    last); ``order`` must be plain columns then.

    ``order`` must be unique within a group, as after a ``groupBy`` on it. A group
    may be of any size: it is cut into blocks, and only block totals are combined.
    ``settled`` says that ``df`` is a written table already; ``known_small`` that its
    largest group was counted and fits one task.
    """
    table = df if settled else settle(df)
    keys = _order(order)
    groups = list(within)
    if known_small:
        whole = Window.partitionBy(*groups)
        earlier = whole.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
        return table.select(
            "*",
            *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"{s}_before") for s in sums],
            *[F.sum(s).over(whole).alias(f"{s}_total") for s in sums],
            *[F.lead(s).over(whole.orderBy(*keys)).alias(f"{s}_next") for s in sums if ahead],
        )

    blocks = settle(
        table.repartitionByRange(*groups, *keys).withColumn("_block", F.spark_partition_id())
    )
    # (block, group) totals: at most blocks + groups rows
    firsts = [F.min_by(F.struct(*sums), F.struct(*order)).alias("_first")] if ahead else []
    parts = blocks.groupBy("_block", *groups).agg(*[F.sum(s).alias(s) for s in sums], *firsts)
    whole = Window.partitionBy(*groups)
    earlier = whole.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "_block",
        *groups,
        *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"_{s}_offset") for s in sums],
        *[F.sum(s).over(whole).alias(f"{s}_total") for s in sums],
        *[F.lead("_first").over(whole.orderBy("_block")).alias("_follows") for _ in firsts],
    )
    ordered = Window.partitionBy("_block", *groups).orderBy(*keys)
    in_block = ordered.rowsBetween(Window.unboundedPreceding, -1)
    local = blocks.select(
        "*",
        *[F.coalesce(F.sum(s).over(in_block), F.lit(0)).alias(f"_{s}_local") for s in sums],
        *[F.lead(F.struct(*sums)).over(ordered).alias("_near") for _ in firsts],
    )
    joined = local.join(offsets, _same(local, offsets, ["_block", *groups]))
    return joined.select(
        *[local[c] for c in table.columns],
        *[(F.col(f"_{s}_local") + F.col(f"_{s}_offset")).alias(f"{s}_before") for s in sums],
        *[F.col(f"{s}_total") for s in sums],
        *[F.coalesce("_near", "_follows")[s].alias(f"{s}_next") for s in sums if ahead],
    )


def value_table(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct values with their counts ``n``, without null and NaN: combined before the shuffle."""
    return (
        df.filter(present(df, value).isNotNull())
        .groupBy(*by, value)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def quantiles_of_counts(
    counts: DataFrame,
    value: str,
    probs: dict[str, float],
    by: Sequence[str] = (),
    known_small: bool = False,
    settled: bool = False,
) -> DataFrame:
    """Linear-interpolated quantiles from ``(by, value, n)``, one row per group."""
    ranked = running_totals(
        counts, ["n"], [value], within=by, known_small=known_small, settled=settled
    )
    last = F.col("n_before") + F.col("n")
    aggregates = []
    for name, p in probs.items():
        position = F.lit(float(p)) * (F.col("n_total") - 1)
        for end, index in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            here = (F.col("n_before") <= index) & (index < last)
            aggregates.append(F.max(F.when(here, F.col(value).cast("double"))).alias(f"_{name}_{end}"))
    aggregates.append(F.max("n_total").alias("_n"))
    picked = ranked.groupBy(*by).agg(*aggregates)

    def interpolate(name: str, p: float) -> Column:
        position = F.lit(float(p)) * (F.col("_n") - 1)
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        return (low + (high - low) * (position - F.floor(position))).alias(name)

    return picked.select(*by, *[interpolate(name, p) for name, p in probs.items()])


def exact_quantiles(
    df: DataFrame, value: str, probs: dict[str, float], by: Sequence[str] = (), **options: bool
) -> DataFrame:
    """Exact quantiles of the non-null values per group."""
    return quantiles_of_counts(value_table(df, value, by), value, probs, by, **options)
