"""Lookup joins to unique keys, and orphan detection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.session import settle

# Most rows of a lookup that is handled in one task; checked against a real count.
BROADCAST_ROWS = 100_000


def counted(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Compute a lookup once; also tells whether it is small enough for one task."""
    table = settle(df)
    return table, table.count() <= max_rows


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Mapping[str, str] | Sequence[str],
    known_unique: bool = False,
) -> DataFrame:
    """LEFT equi-join to a unique-keyed lookup; single or composite key.

    ``on`` maps row columns to lookup columns; the lookup's key columns are
    dropped from the result. Null keys match nothing. The lookup is written once, so
    Spark broadcasts it or not by its real bytes, and splits hot keys of a shuffle.
    A key that the lookup has twice raises; ``known_unique`` says that the caller has
    grouped by it.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {c: c for c in on}
    side = lookup.select(
        *[F.col(there).alias(f"_on_{here}") for here, there in pairs.items()],
        *[c for c in lookup.columns if c not in pairs.values()],
    )
    if not known_unique:
        side = settle(side)
        keys = [f"_on_{here}" for here in pairs]
        twice = side.na.drop(subset=keys).groupBy(*keys).count().filter("count > 1").first()
        if twice:
            raise ValueError(f"the lookup has a key twice: {twice.asDict()}")
    condition = None
    for here in pairs:
        equal = rows[here] == side[f"_on_{here}"]
        condition = equal if condition is None else condition & equal
    return rows.join(side, condition, "left").drop(*[f"_on_{here}" for here in pairs])


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose non-null foreign key is missing in the parent."""
    keys = settle(parent.select(F.col(key).alias("_parent")).distinct())
    present = child.filter(F.col(foreign_key).isNotNull())
    return present.join(keys, present[foreign_key] == keys["_parent"], "left_anti")
