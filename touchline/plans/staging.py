"""Raw tables -> typed, cleaned staging tables, one function per entity."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions import (
    code_to_words,
    month_text_to_date,
    pluck,
    slug,
    split_text,
    surrogate_key,
    year_to_date,
)
from touchline.operators.dedup import any_row, latest_row
from touchline.operators.overrides import corrected
from touchline.plans import values as v


def typed(df: DataFrame, columns: Mapping[str, tuple[str | Column, str]]) -> DataFrame:
    """Project every column with a cast: ``{new name: (field path or expression, type)}``."""
    return df.select(
        *[
            (F.col(field) if isinstance(field, str) else field).cast(dtype).alias(name)
            for name, (field, dtype) in columns.items()
        ]
    )


def stage_areas(raw: DataFrame) -> DataFrame:
    return typed(
        raw,
        {
            # the keys are made from the names as delivered, before any correction
            "country_id": (surrogate_key("country", "name"), "string"),
            "area_id": ("id", "string"),
            "country_name": (corrected("name", "id", v.COUNTRY_NAME_BY_ID), "string"),
            "country_code": ("countryCode", "string"),
            "continent_id": (surrogate_key("continent", "parentArea"), "string"),
            "continent_name": (corrected("parentArea", "parentArea", v.CONTINENT_NAMES), "string"),
            "parent_area_id": ("parentAreaId", "string"),
        },
    )


def stage_competitions(raw: DataFrame) -> DataFrame:
    return typed(
        raw,
        {
            "competition_id": ("id", "string"),
            "competition_name": ("name", "string"),
            "competition_code": ("code", "string"),
            "competition_type": (F.lower("type"), "string"),
            "country_name": ("area.name", "string"),
            "current_season_id": ("currentSeason.id", "string"),
        },
    )


def current_matches(raw: DataFrame, as_of: Column) -> DataFrame:
    """Newest row of each match, without last year's matches of the single-year competitions."""
    newest = latest_row(raw, ["id"], "lastUpdated")
    last_year = F.year(F.col("utcDate").cast("timestamp_ntz")) == F.year(as_of) - 1
    # a match whose competition or date is unknown may satisfy both, so it is dropped as well
    return newest.filter(~(F.col("competition.id").isin(*v.SINGLE_YEAR_COMPETITIONS) & last_year))


def stage_matches(raw: DataFrame, as_of: Column) -> DataFrame:
    winners = {"HOME_TEAM": "home", "AWAY_TEAM": "away", "DRAW": "draw"}
    return typed(
        current_matches(raw, as_of),
        {
            "match_id": ("id", "string"),
            "match_at": ("utcDate", "timestamp_ntz"),
            "status": (code_to_words("status"), "string"),
            "matchday_number": ("matchday", "int"),
            "stage": (code_to_words("stage"), "string"),
            "home_team_id": ("homeTeam.id", "string"),
            "away_team_id": ("awayTeam.id", "string"),
            "referees_ids": (pluck("referees", "id"), "array<string>"),
            "winner": (corrected(F.lit(None), "winner", winners), "string"),
            "duration_type": (code_to_words("duration"), "string"),
            **{
                f"{half}_time_{side}_score": (f"{half}_time.{side}", "int")
                for half in ("full", "half")
                for side in ("home", "away")
            },
            "area_id": ("area.id", "string"),
            "competition_id": ("competition.id", "string"),
            "season_id": ("season.id", "string"),
            "last_updated_at": ("lastUpdated", "timestamp_ntz"),
        },
    )


def stage_teams(raw: DataFrame) -> DataFrame:
    """One row per team; of several competitions the one with the smallest id is kept."""
    named = corrected(F.lit(None).cast("date"), "name", v.FOUNDATION_BY_TEAM)
    founded = F.when(F.col("founded").isNull(), named).otherwise(year_to_date("founded"))
    return typed(
        any_row(raw, ["id"], ties=["competition.id"]),
        {
            "team_id": ("id", "string"),
            "team_name": ("name", "string"),
            "team_short_name": ("shortName", "string"),
            "team_code": ("tla", "string"),
            "country_name": ("area.name", "string"),
            "team_address": ("address", "string"),
            "website_url": ("website", "string"),
            "logo_url": ("crest", "string"),
            "foundation_year_date": (founded, "date"),
            "team_colors": (split_text("clubColors", " / "), "array<string>"),
            "arena_name": ("venue", "string"),
            "main_competition_id": ("competition.id", "string"),
            "running_competitions_ids": (pluck("runningCompetitions", "id"), "array<string>"),
            "player_ids": (pluck("squad", "id"), "array<string>"),
            "coach_id": ("coach.id", "string"),
            "coach_contract_start_date": (month_text_to_date("coach.contract.start"), "date"),
            "coach_contract_end_date": (month_text_to_date("coach.contract.until"), "date"),
            "season_id": ("season.id", "string"),
        },
    )


def stage_coaches(raw: DataFrame) -> DataFrame:
    """The coach of each team: one who has two teams appears twice."""
    return typed(
        any_row(raw.filter(F.col("id").isNotNull()).select("id", "coach"), ["id"]),
        {
            "coach_id": ("coach.id", "string"),
            "first_name": ("coach.firstName", "string"),
            "last_name": ("coach.lastName", "string"),
            "full_name": ("coach.name", "string"),
            "birth_date": ("coach.dateOfBirth", "date"),
            "nationality": ("coach.nationality", "string"),
        },
    )


def stage_referees(raw: DataFrame) -> DataFrame:
    people = raw.select(F.explode("referees").alias("person")).select("person.*")
    return typed(
        people,
        {
            "referee_id": ("id", "string"),
            "full_name": ("name", "string"),
            "nationality": (corrected("nationality", "id", v.NATIONALITY_BY_REFEREE), "string"),
        },
    ).distinct()


def stage_seasons(raw: DataFrame) -> DataFrame:
    found = typed(
        raw,
        {
            "season_id": ("season.id", "string"),
            "start_date": ("season.startDate", "date"),
            "end_date": ("season.endDate", "date"),
            "competition_id": ("competition.id", "string"),
            "competition_name": ("competition.name", "string"),
        },
    ).distinct()
    readable = F.concat(slug("competition_name"), F.lit("_"), F.year("start_date"), F.lit("_"), F.year("end_date"))
    return found.withColumn("season_uid", readable).drop("competition_name")


def stage_players(raw: DataFrame) -> DataFrame:
    nationality = corrected(corrected("nationality", "nationality", v.NATIONALITY_NAMES), "id", v.NATIONALITY_BY_PLAYER)
    return typed(
        raw,
        {
            "player_id": ("id", "string"),
            "name": ("name", "string"),
            "first_name": ("firstName", "string"),
            "last_name": ("lastName", "string"),
            "date_of_birth": (corrected(F.col("dateOfBirth").cast("date"), "id", v.BIRTH_DATE_BY_PLAYER), "date"),
            "nationality": (nationality, "string"),
            "section": ("section", "string"),
            "position": ("position", "string"),
            "player_number": ("shirtNumber", "int"),
            "current_team_id": ("current_team_id", "string"),
            "contract_start_month": (month_text_to_date("player_contract.start"), "date"),
            "contract_end_month": (month_text_to_date("player_contract.until"), "date"),
            "last_updated_at": ("lastUpdated", "timestamp_ntz"),
        },
    )


