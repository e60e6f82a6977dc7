"""Tables replaced only by what keeps their contract and passes their checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from touchline.operators.contract import enforce_contract
from touchline.operators.quality import Check, require
from touchline.sources.tables import create_or_replace


def publish(df: DataFrame, table: str, contract: Mapping[str, str], checks: Sequence[Check] = ()) -> DataFrame:
    """Replace ``table`` with ``df`` in its declared columns, unless something is wrong with it.

    A name or type that differs raises before anything is written. The checks run on the version as it was
    written, so ``df`` is computed once, and before anyone can read it: if one of severity error fails, that
    version is dropped and the table stays as it was. Checks that only warn do not hold it back.
    """
    accept = (lambda written: require(written, checks)) if checks else None
    return create_or_replace(enforce_contract(df, contract), table, accept)
