"""Column encodings: flags, ordinals, bands, labels, one-hot and back.

Everything is a built-in expression, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Band:
    """Contiguous bands; ``closed`` names the side that takes the cut value.

    ``left``: value < cut belongs to the band; ``right``: value <= cut does.
    Values above the last cut, and nulls, go to the last label.
    """

    cuts: Sequence[float]
    labels: Sequence[str]
    closed: str = "right"

    def __post_init__(self) -> None:
        if len(self.labels) != len(self.cuts) + 1:
            raise ValueError("a band needs one label more than cuts")
        if list(self.cuts) != sorted(self.cuts):
            raise ValueError("cuts must ascend")


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def _first_match(cases: Sequence[tuple[Column, Column]]) -> Column:
    """CASE WHEN over (condition, value); null when nothing matches."""
    (condition, value), *rest = cases
    return reduce(lambda acc, case: acc.when(*case), rest, F.when(condition, value))


def binary_flag(column: Column | str, positive: object) -> Column:
    """1 where the column equals ``positive``, else 0; null counts as 0."""
    return F.when(_col(column) == F.lit(positive), 1).otherwise(0)


def threshold_flag(column: Column | str, comparison: str, bound: float) -> Column:
    """1 where ``column <comparison> bound`` holds, else 0; null counts as 0."""
    column = _col(column)
    holds = {
        "<": column < bound,
        "<=": column <= bound,
        "=": column == bound,
        ">=": column >= bound,
        ">": column > bound,
    }[comparison]
    return F.when(holds, 1).otherwise(0)


def decode(column: Column | str, labels: Mapping[object, object], default: object = None) -> Column:
    """Code -> label (or label -> code); unmatched values become ``default``."""
    column = _col(column)
    chosen = _first_match([(column == F.lit(k), F.lit(v)) for k, v in labels.items()])
    return chosen if default is None else chosen.otherwise(F.lit(default))


def yes_no(column: Column | str, yes: str = "Yes", no: str = "No") -> Column:
    """1 -> yes, everything else -> no."""
    return F.when(_col(column) == 1, yes).otherwise(no)


def band(column: Column | str, spec: Band) -> Column:
    """Label of the band a value falls in."""
    column = _col(column)
    below = [column < cut if spec.closed == "left" else column <= cut for cut in spec.cuts]
    cases = [(test, F.lit(label)) for test, label in zip(below, spec.labels)]
    return _first_match(cases).otherwise(spec.labels[-1])


def one_hot(column: Column | str, vocabulary: Mapping[str, object]) -> list[Column]:
    """One 0/1 column per level of a fixed vocabulary; every level is kept."""
    return [binary_flag(column, value).alias(name) for name, value in vocabulary.items()]


def one_hot_decode(vocabulary: Mapping[str, object], default: str | None = None) -> Column:
    """Indicators back to their label: the first set one, else ``default``."""
    label = _first_match([(F.col(name) == 1, F.lit(v)) for name, v in vocabulary.items()])
    return label if default is None else label.otherwise(default)


def product(factors: Sequence[str | tuple[str, object]]) -> Column:
    """Product of columns and ``(column, value)`` indicators."""
    columns = [F.col(f) if isinstance(f, str) else binary_flag(*f) for f in factors]
    return reduce(lambda a, b: a * b, columns)
