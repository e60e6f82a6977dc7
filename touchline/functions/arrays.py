"""Array expressions: no explode, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline.functions._columns import as_column


def pluck(items: Column | str, field: str, dtype: str = "string") -> Column:
    """List of structs -> list of one field. Empty and NULL lists give NULL; NULL fields stay."""
    items = as_column(items)
    return F.when(F.size(items) > 0, F.transform(items, lambda item: item[field].cast(dtype)))


def list_length(items: Column | str) -> Column:
    """Number of elements as BIGINT; NULL for a NULL list."""
    return F.array_size(as_column(items)).cast("bigint")


def holds(items: Column | str, value: Column | str) -> Column:
    """Whether ``value`` is an element of the list."""
    return F.array_contains(as_column(items), as_column(value))
