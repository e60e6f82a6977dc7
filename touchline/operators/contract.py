"""Declared output columns: names and types must match."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


class ContractBroken(TypeError):
    pass


def contract_breaks(df: DataFrame, contract: Mapping[str, str]) -> list[tuple[str, str | None, str | None]]:
    """(column, declared type, actual type) of every column that differs."""
    actual = {field.name: field.dataType.simpleString() for field in df.schema}
    declared = {
        name: StructType.fromDDL(f"`{name}` {dtype}")[name].dataType.simpleString() for name, dtype in contract.items()
    }
    names = [*declared, *[name for name in actual if name not in declared]]
    return [(n, declared.get(n), actual.get(n)) for n in names if declared.get(n) != actual.get(n)]


def enforce_contract(df: DataFrame, contract: Mapping[str, str]) -> DataFrame:
    """``df`` with its columns in declared order; raises if a name or type differs.

    Only the schema is looked at, so nothing runs.
    """
    breaks = contract_breaks(df, contract)
    if breaks:
        raise ContractBroken("; ".join(f"{n}: declared {want}, found {got}" for n, want, got in breaks))
    return df.select(*contract)


def contract_report(df: DataFrame, contract: Mapping[str, str]) -> DataFrame:
    """The breaks as a frame; empty if the contract holds."""
    schema = "column_name string, declared_type string, actual_type string"
    return df.sparkSession.createDataFrame(contract_breaks(df, contract), schema)
