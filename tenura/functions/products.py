"""Pairwise sums of many columns at once, for correlations with holes."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle

# the function travels with the plan: workers need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAIR_SUMS = "i int, j int, n double, x double, y double, xx double, yy double, xy double, endless double"


def pair_sums(k: int, shifts: list[float]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Per task, sums over the rows in which both columns of a pair have a value.

    Values are taken relative to ``shifts``, so that large means cost no digits. ``endless``
    counts the rows with both values of which one is infinite; they add to no other sum than ``n``.
    """
    upper = np.triu_indices(k)

    def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((7, k, k))
        for frame in frames:
            values = frame.to_numpy(dtype=np.float64, na_value=np.nan) - np.asarray(shifts)
            there = (~np.isnan(values)).astype(np.float64)
            endless = np.isinf(values).astype(np.float64)
            values = np.where((there > 0) & (endless == 0), values, 0.0)
            squares = values * values
            total += np.stack([
                there.T @ there, values.T @ there, there.T @ values, squares.T @ there, there.T @ squares, values.T @ values,
                endless.T @ there + there.T @ endless,
            ])
        cells = total[:, upper[0], upper[1]]
        yield pd.DataFrame(
            {"i": upper[0].astype(np.int32), "j": upper[1].astype(np.int32)}
            | dict(zip(("n", "x", "y", "xx", "yy", "xy", "endless"), cells, strict=True))
        )

    return task
