"""Whole runs of the warehouse: raw nested tables to marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from registry import derived as d
from registry import facts, raw, staged
from registry.register import Entry, with_sql
from touchline.plans import checks, warehouse
from touchline.sources.tables import scratch_table

AS_OF = dt.date.fromisoformat(staged.AS_OF)

# read by several later tables
SHARED = ("stg_matches", "stg_teams", "stg_competitions", "seasons", "standings_versions")


def build(spark: SparkSession, folder: str, *wanted: str) -> dict[str, DataFrame]:
    tables = {
        "areas": raw.areas(spark, folder),
        "competitions": raw.competitions(spark, folder),
        "matches": raw.matches(spark, folder),
        "teams": raw.teams(spark, folder),
        "players": raw.players(spark, folder),
    }
    write = lambda name, df: scratch_table(df, name) if name in SHARED else df
    return warehouse.build(tables, AS_OF, write, wanted)


def built_streaks(spark: SparkSession, folder: str) -> DataFrame:
    return facts._readable(build(spark, folder, "streaks")["streaks"])


def _final_select(sql: str) -> str:
    """The query of a statement that starts with the pairings."""
    return sql.split(d.SQL_PAIRINGS, 1)[1].strip()


_TABLES = [
    d.SQL_PAIRINGS,
    f"matches AS ({_final_select(staged.STAGE_MATCHES)})",
    d.SQL_SIDES,
    staged._TEAM,
    f"teams AS ({staged.STAGE_TEAMS.split(staged._TEAM, 1)[1].strip()})",
    f"competitions AS ({staged.STAGE_COMPETITIONS})",
]

BUILT_STREAKS = with_sql(
    *_TABLES,
    *facts._ISLANDS[-2:],
    facts._STREAK_SELECT.format(
        key="competition_id || team_id || CAST(island AS BIGINT)", first="min(match_id)", last="max(match_id)"
    ),
)


def built_weekly(spark: SparkSession, folder: str) -> DataFrame:
    return build(spark, folder, "standings_weekly")["standings_weekly"]


SEASONS = f"""seasons AS (
          SELECT season_id, competition_name || CASE WHEN competition_id = '2013' THEN ' 2001' ELSE ' 2001 - 2002' END
                   AS season_name
          FROM ({staged.STAGE_SEASONS}) AS staged LEFT JOIN competitions USING (competition_id))"""

# all weeks of the calendar as well
BUILT_WEEKLY = with_sql(
    *_TABLES,
    SEASONS,
    *facts._HISTORY[-2:],
    *facts.weekly_parts(
        "least(min(version_start_at), TIMESTAMP '2000-01-01')", "greatest(max(version_end_at), TIMESTAMP '2049-12-31')"
    ),
)


def built(name: str):
    """A mart as the whole run makes it, from the raw tables."""
    return lambda spark, folder: build(spark, folder, name)[name]


def built_playoffs(spark: SparkSession, folder: str) -> DataFrame:
    """The knockout listing, its list as text as in the staged SQL."""
    return staged.as_text(built("playoff_matches")(spark, folder))


BUILT_VERSIONS = with_sql(*_TABLES, SEASONS, *facts._HISTORY[-2:], "FROM history")
BUILT_MATCH_FACTS = with_sql(*_TABLES, *facts.MATCH_FACTS_PARTS)
BUILT_STANDINGS = with_sql(*_TABLES, *facts.STANDINGS_PARTS)
BUILT_PLAYOFFS = with_sql(*_TABLES, *facts.PLAYOFF_PARTS)


def checked(spark: SparkSession, folder: str) -> DataFrame:
    """Every declared check of every table of a whole run: 470 of them, each table scanned a few times only."""
    tables = {
        "areas": raw.areas(spark, folder),
        "competitions": raw.competitions(spark, folder),
        "matches": raw.matches(spark, folder),
        "teams": raw.teams(spark, folder),
        "players": raw.players(spark, folder),
    }
    return checks.run_declared(warehouse.build(tables, AS_OF, lambda name, df: scratch_table(df, name)), AS_OF)


ENTRIES = {
    "warehouse_streaks": Entry(built_streaks, BUILT_STREAKS),
    "warehouse_weekly": Entry(built_weekly, BUILT_WEEKLY),
    "warehouse_versions": Entry(built("standings_versions"), BUILT_VERSIONS),
    "warehouse_match_facts": Entry(built("matches_per_team"), BUILT_MATCH_FACTS),
    "warehouse_standings": Entry(built("standings_current"), BUILT_STANDINGS),
    "warehouse_playoffs": Entry(built_playoffs, BUILT_PLAYOFFS),
    # no SQL: the tests compare it with each check run on its own
    "warehouse_checks": Entry(checked, None),
}
