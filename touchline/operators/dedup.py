"""One row per key, and whole-row dedup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchline.functions._columns import as_column


def latest_row(
    df: DataFrame,
    keys: Sequence[str],
    newest: Column | str,
    ties: Sequence[Column | str] = (),
) -> DataFrame:
    """The row with the greatest ``newest`` of each key; NULL counts as oldest.

    Spark keeps one row per key and map task before the shuffle (``WindowGroupLimit``), so a
    key with a large share of all rows is no burden. Ties fall to ``ties`` (ascending), which should
    settle them. Without ``ties`` they fall to a hash of the whole row: that makes the choice
    repeatable too, but reads and hashes every column.
    """
    order = [as_column(newest).desc_nulls_last(), *_tie_order(df, ties)]
    return _first_row(df, keys, order)


def any_row(df: DataFrame, keys: Sequence[str], ties: Sequence[Column | str] = ()) -> DataFrame:
    """One row of each key, the same one on every run."""
    return _first_row(df, keys, _tie_order(df, ties))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row dedup; struct and array columns are fine."""
    return df.distinct()


def _tie_order(df: DataFrame, ties: Sequence[Column | str]) -> list[Column]:
    return [as_column(tie).asc_nulls_last() for tie in ties] or [F.xxhash64(*df.columns)]


def _first_row(df: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__place", place).filter("__place = 1").drop("__place")
