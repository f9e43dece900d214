"""Clean table: encoded flags, ordinal travel, snake-case names, constants dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura import specs
from tenura.functions.encode import binary_flag, decode


def clean(raw: DataFrame, keep_key: bool = True) -> DataFrame:
    """Raw 35 columns to the 32 clean ones, plus the employee number as key."""
    built = {
        **{new: F.col(old) for old, new in specs.RENAMES.items()},
        **{name: binary_flag(column, yes) for name, (column, yes) in specs.FLAGS.items()},
        "business_travel_encoded": decode("BusinessTravel", specs.TRAVEL_ORDER),
    }
    columns = [built[name].alias(name) for name in specs.CLEAN_COLUMNS]
    if keep_key:
        columns.append(F.col(specs.ID_COLUMN).alias(specs.KEY))
    return raw.select(*columns)
