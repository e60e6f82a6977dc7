"""All tables of the football warehouse, from the five raw ones."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.operators import dims
from touchline.operators.calendar import END_DAY, FIRST_DAY, calendar
from touchline.operators.contract import enforce_contract
from touchline.operators.grid import weeks, weeks_of
from touchline.operators.sides import match_facts, per_side
from touchline.operators.standings import standings, with_placement
from touchline.operators.streaks import team_streaks
from touchline.operators.versions import standings_versions, weekly_standings, with_open_end
from touchline.plans import contracts, staging
from touchline.plans import values as v

RAW = ("areas", "competitions", "matches", "teams", "players")

Write = Callable[[str, DataFrame], DataFrame]
Tables = Mapping[str, DataFrame]


def keep_lazy(name: str, df: DataFrame) -> DataFrame:
    return df


def no_points() -> Column:
    """Knockout matches of the Champions League know no points."""
    return (F.col("competition_id") == v.CHAMPIONS_LEAGUE) & (F.col("stage") != "league stage")


def _weekly(history: DataFrame) -> DataFrame:
    """All weeks of the calendar, those without any table too, and all weeks of the history."""
    of_history = weeks_of(with_open_end(history), "version_start_at", "version_end_at")
    grid = weeks(FIRST_DAY, END_DAY).covering(of_history)
    # not sorted: a table has no order, and sorting it would cost a further shuffle
    return weekly_standings(history, grid).select(*contracts.WEEKLY)


def _playoffs(matches: DataFrame, teams: DataFrame, competitions: DataFrame) -> DataFrame:
    return dims.playoff_matches(matches, teams, competitions, v.CHAMPIONS_LEAGUE, v.PLAYOFF_STAGE_ORDER)


# name -> (tables it reads, declared columns, how it is made of those tables and the day)
MODELS = {
    "stg_areas": (["raw.areas"], contracts.AREAS, lambda raw, day: staging.stage_areas(raw)),
    "stg_competitions": (["raw.competitions"], contracts.COMPETITIONS, lambda raw, day: staging.stage_competitions(raw)),
    "stg_matches": (["raw.matches"], contracts.MATCHES, staging.stage_matches),
    "stg_teams": (["raw.teams"], contracts.TEAMS, lambda raw, day: staging.stage_teams(raw)),
    "stg_coaches": (["raw.teams"], contracts.COACHES, lambda raw, day: staging.stage_coaches(raw)),
    "stg_referees": (["raw.matches"], contracts.REFEREES, lambda raw, day: staging.stage_referees(raw)),
    "stg_seasons": (["raw.teams"], contracts.STAGED_SEASONS, lambda raw, day: staging.stage_seasons(raw)),
    "stg_players": (["raw.players"], contracts.STAGED_PLAYERS, lambda raw, day: staging.stage_players(raw)),
    "int_matches_per_team": (["stg_matches"], contracts.MATCHES_PER_TEAM, lambda matches, day: per_side(matches)),
    "countries": (["stg_areas"], contracts.COUNTRIES, lambda areas, day: dims.countries(areas)),
    "continents": (["stg_areas"], contracts.CONTINENTS, lambda areas, day: dims.continents(areas)),
    "calendar": (["raw.matches"], contracts.CALENDAR, lambda any_table, day: calendar(any_table.sparkSession)),
    "seasons": (
        ["stg_seasons", "stg_competitions"],
        contracts.SEASONS,
        lambda seasons, competitions, day: dims.seasons(seasons, competitions, [v.BRAZILIAN_LEAGUE]),
    ),
    "players": (["stg_players", "stg_teams", "stg_competitions"], contracts.PLAYERS, dims.players),
    "matches_per_team": (
        ["stg_matches", "stg_teams", "stg_competitions"],
        contracts.MATCH_FACTS,
        lambda matches, teams, competitions, day: match_facts(matches, teams, competitions, no_points()),
    ),
    "standings_current": (
        ["stg_matches", "stg_teams", "stg_competitions"],
        contracts.STANDINGS,
        lambda matches, teams, competitions, day: with_placement(standings(matches), teams, competitions),
    ),
    "standings_versions": (
        ["stg_matches", "stg_teams", "stg_competitions", "seasons"],
        contracts.VERSIONS,
        lambda matches, teams, competitions, seasons, day: standings_versions(matches, teams, competitions, seasons),
    ),
    "standings_weekly": (["standings_versions"], contracts.WEEKLY, lambda history, day: _weekly(history)),
    "streaks": (
        ["int_matches_per_team", "stg_teams", "stg_competitions"],
        contracts.STREAKS,
        lambda sides, teams, competitions, day: team_streaks(sides, teams, competitions),
    ),
    "playoff_matches": (
        ["stg_matches", "stg_teams", "stg_competitions"],
        contracts.PLAYOFFS,
        lambda matches, teams, competitions, day: _playoffs(matches, teams, competitions),
    ),
}


def build(
    raw: Tables, as_of: dt.date, write: Write = keep_lazy, wanted: Collection[str] = ()
) -> dict[str, DataFrame]:
    """Every table by name, columns and types as declared; or those ``wanted`` and what they read.

    ``write(name, frame)`` may store a table and return what later ones shall read, for example
    ``lambda name, df: create_or_replace(df, name)``. Do so at scale: matches and versions feed
    several tables, and the skew checks read their inputs once more.
    """
    needed = set(wanted or MODELS)
    for name in reversed(MODELS):
        if name in needed:
            needed.update(MODELS[name][0])
    known = {f"raw.{name}": df for name, df in raw.items()}
    tables: dict[str, DataFrame] = {}
    for name, (sources, contract, make) in MODELS.items():
        if name in needed:
            inputs = [known[source] for source in sources]
            known[name] = tables[name] = write(name, enforce_contract(make(*inputs, F.lit(as_of)), contract))
    return tables
