"""Value corrections."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions._columns import as_column


def corrected(value: Column | str, key: Column | str, corrections: Mapping) -> Column:
    """``corrections[key]`` where there is one, else ``value``. For short, fixed tables."""
    value, key = as_column(value), as_column(key)
    branches = iter(corrections.items())
    known, replacement = next(branches)
    cases = F.when(key == known, F.lit(replacement))
    for known, replacement in branches:
        cases = cases.when(key == known, F.lit(replacement))
    return cases.otherwise(value)


def apply_overrides(
    df: DataFrame, key: str, column: str, overrides: DataFrame, override_key: str, override_value: str
) -> DataFrame:
    """The same from a table of any size with one row per key.

    No broadcast hint: Spark broadcasts the table if its measured size allows.
    """
    table = overrides.select(
        F.col(override_key).alias("__key"), F.col(override_value).alias("__value"), F.lit(True).alias("__found")
    )
    replaced = F.when(F.col("__found"), F.col("__value")).otherwise(F.col(column))
    return (
        df.join(table, F.col(key) == F.col("__key"), "left")
        .withColumn(column, replaced)
        .drop("__key", "__value", "__found")
    )
