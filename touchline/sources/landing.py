"""API responses that have landed as JSON text, one response per row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CORRUPT = "_corrupt"


def read_payloads(spark: SparkSession, path: str | list[str], whole_file: bool = False) -> DataFrame:
    """One ``payload`` per line, or per file. Files with one response per line can be split."""
    return spark.read.text(path, wholetext=whole_file).withColumnRenamed("value", "payload")


def parse(payloads: DataFrame, schema: str, column: str = "payload") -> DataFrame:
    """Add ``parsed`` with the declared fields; a payload that is no JSON lands in ``_corrupt``.

    The array of one and its explode keep the optimizer from copying the parser into every
    later filter and field access, so each payload is parsed once.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(F.col(column), f"{schema}, {CORRUPT} string", options)
    return payloads.select("*", F.explode(F.array(parsed)).alias("parsed"))


def good(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("parsed").isNotNull() & F.col(f"parsed.{CORRUPT}").isNull())


def bad(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("parsed").isNull() | F.col(f"parsed.{CORRUPT}").isNotNull())


def tally(parsed: DataFrame) -> DataFrame:
    """How many payloads could be read, and how many not."""
    broken = F.col("parsed").isNull() | F.col(f"parsed.{CORRUPT}").isNotNull()
    return parsed.agg(F.count_if(~broken).alias("good"), F.count_if(broken).alias("bad"))


def land(
    payloads: DataFrame,
    endpoint: str,
    element: str,
    columns: Sequence[str] | None = None,
    parents: Mapping[str, str] | None = None,
    column: str = "payload",
) -> DataFrame:
    """Rows of a response's top-level array ``endpoint``, with a fixed list of columns.

    ``element`` declares the fields of one array element, so fields absent from the JSON are
    NULL and others are not even parsed. ``parents`` are fields of the response itself that are
    set beside every element. Unreadable payloads are left out; see :func:`bad`.
    """
    parents = parents or {}
    schema = ", ".join([f"{endpoint} array<struct<{_inline(element)}>>", *[f"{n} {t}" for n, t in parents.items()]])
    rows = good(parse(payloads, schema, column)).select(
        F.explode(f"parsed.{endpoint}").alias("element"), *[F.col(f"parsed.{name}") for name in parents]
    )
    rows = rows.select("element.*", *parents)
    return rows.select(*columns, *parents) if columns else rows


def land_objects(payloads: DataFrame, element: str, column: str = "payload") -> DataFrame:
    """The same where each response is one object."""
    return good(parse(payloads, element, column)).select("parsed.*").drop(CORRUPT)


def _inline(ddl: str) -> str:
    """``a int, b struct<c:int>`` -> ``a:int,b:struct<c:int>``."""
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl).simpleString()[len("struct<") : -1]


def concat_pages(pages: Sequence[DataFrame]) -> DataFrame:
    """One frame out of many, matched by column name; a missing column is NULL."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), pages)


def flatten(df: DataFrame, column: str, fields: Mapping[str, str]) -> DataFrame:
    """Promote fields of a struct to columns and drop the struct."""
    return df.withColumns({name: F.col(f"{column}.{field}") for field, name in fields.items()}).drop(column)


def without_fields(column: Column | str, *fields: str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).dropFields(*fields)


def matches_table(payloads: DataFrame, element: str) -> DataFrame:
    """The raw match table: pages landed, scores flattened, whole-row duplicates dropped."""
    # column names of the raw table: fixed values
    fields = {"winner": "winner", "duration": "duration", "fullTime": "full_time", "halfTime": "half_time"}
    return flatten(land(payloads, "matches", element), "score", fields).distinct()


def teams_table(payloads: DataFrame, element: str, parents: Mapping[str, str]) -> DataFrame:
    """The raw team table: competition and season of the response beside each team."""
    teams = land(payloads, "teams", element, parents=parents)
    return teams.withColumn("season", without_fields("season", "winner"))


def players_table(payloads: DataFrame, element: str) -> DataFrame:
    """The raw player table: the keys kept, team id and contract taken out of the current team.

    A response without a current team is an error response and left out.
    """
    people = land_objects(payloads, element).filter(F.col("currentTeam").isNotNull())
    return flatten(people, "currentTeam", {"id": "current_team_id", "contract": "player_contract"})
