"""Feature table: ratios, composites, flags, interactions, group context, one-hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura import specs
from tenura.functions.arithmetic import mean_of, ratio
from tenura.functions.encode import one_hot, product, threshold_flag
from tenura.operators.aggregate import means_from_rollup, rollup_means
from tenura.operators.joins import lookup_join
from tenura.session import settle


def ratio_columns() -> list:
    return [ratio(*parts).alias(name) for name, parts in specs.RATIOS.items()]


def composite_columns() -> list:
    return [mean_of(columns).alias(name) for name, columns in specs.COMPOSITES.items()]


def flag_columns() -> list:
    return [threshold_flag(*test).alias(name) for name, test in specs.THRESHOLD_FLAGS.items()]


def interaction_columns() -> list:
    return [product(factors).alias(name) for name, factors in specs.INTERACTIONS.items()]


def one_hot_columns() -> list:
    return [c for column, names in specs.ONE_HOT.items() for c in one_hot(column, names)]


def relative_columns() -> list:
    return [ratio(*parts).alias(name) for name, parts in specs.RELATIVES.items()]


def group_context(silver: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Department and role aggregates from one scan of the clean table.

    Sums per (department, role) are computed once; both levels are rolled up from
    them, so the keys of both are unique.
    """
    measures = list(dict.fromkeys([*specs.DEPARTMENT_CONTEXT.values(), *specs.ROLE_CONTEXT.values()]))
    fine = settle(rollup_means(silver, ["department", "job_role"], measures))
    by_department = means_from_rollup(fine, "department", specs.DEPARTMENT_CONTEXT, specs.DEPARTMENT_HEADCOUNT)
    by_role = means_from_rollup(fine, "job_role", specs.ROLE_CONTEXT, specs.ROLE_HEADCOUNT)
    return by_department, by_role


def with_group_context(silver: DataFrame) -> DataFrame:
    """Clean rows with their department's and role's aggregates."""
    by_department, by_role = group_context(silver)
    joined = lookup_join(silver, by_department, ["department"], known_unique=True)
    return lookup_join(joined, by_role, ["job_role"], known_unique=True)


def ml_features(silver: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Target first, then the 77 features; nothing is computed from the target.

    ``keep`` carries extra clean columns (such as the key) behind them.
    """
    joined = with_group_context(silver)
    return joined.select(
        "attrition",
        *specs.NUMERIC_FEATURES,
        *specs.BINARY_FEATURES,
        *ratio_columns(),
        *composite_columns(),
        *flag_columns(),
        *interaction_columns(),
        *[c for c in specs.CONTEXT_FEATURES if c not in specs.RELATIVES],
        *relative_columns(),
        *one_hot_columns(),
        *[F.col(c) for c in keep],
    )
