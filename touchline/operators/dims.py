"""Dimensions and listings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions._columns import as_column
from touchline.functions.dates import completed_years


def countries(areas: DataFrame) -> DataFrame:
    return areas.filter(F.col("country_name") != "World").select(
        "country_id", "area_id", "country_name", "country_code", "continent_id"
    )


def continents(areas: DataFrame) -> DataFrame:
    known = F.col("continent_id").isNotNull() & (F.col("continent_name") != "World")
    return areas.filter(known).select("continent_id", "continent_name").distinct()


def season_name(name: Column | str, start: Column | str, end: Column | str, single_year: Column) -> Column:
    """``Liga 2024`` for a season within one year, else ``Liga 2024 - 2025``."""
    first = F.concat(as_column(name), F.lit(" "), F.year(as_column(start)).cast("string"))
    both = F.concat(first, F.lit(" - "), F.year(as_column(end)).cast("string"))
    return F.when(single_year, first).otherwise(both)


def seasons(staged: DataFrame, competitions: DataFrame, single_year_ids: Sequence[str]) -> DataFrame:
    names = competitions.select("competition_id", "competition_name")
    single = F.col("competition_id").isin(*single_year_ids)
    return staged.join(names, "competition_id", "left").select(
        "season_id",
        "start_date",
        "end_date",
        "competition_id",
        "competition_name",
        season_name("competition_name", "start_date", "end_date", single).alias("season_name"),
    )


def players(staged: DataFrame, teams: DataFrame, competitions: DataFrame, as_of: Column) -> DataFrame:
    """Players with team, competition and age on the day ``as_of``."""
    clubs = teams.select(
        F.col("team_id").alias("current_team_id"), "team_name", F.col("main_competition_id").alias("competition_id")
    )
    return (
        staged.join(clubs, "current_team_id", "left")
        .join(competitions.select("competition_id", "competition_name"), "competition_id", "left")
        .select(
            "player_id",
            "name",
            "date_of_birth",
            completed_years("date_of_birth", as_of).alias("age"),
            "nationality",
            "section",
            "position",
            "player_number",
            F.col("current_team_id").alias("team_id"),
            "team_name",
            # the club's own id: known even where the competition table lacks it
            "competition_id",
            "competition_name",
            "contract_start_month",
            "contract_end_month",
        )
    )


def constants(df: DataFrame, columns: Sequence[str], rows: Mapping) -> DataFrame:
    """A fixed two-column table; its size is that of the literal, so it may be broadcast."""
    return df.sparkSession.createDataFrame(list(rows.items()), list(columns))


def playoff_matches(
    matches: DataFrame,
    teams: DataFrame,
    competitions: DataFrame,
    competition_id: str,
    stage_order: Mapping[str, int],
    league_stage: str = "league stage",
) -> DataFrame:
    """Knockout matches of one competition, both teams named, the latest stage first."""
    played = matches.filter((F.col("competition_id") == competition_id) & (F.col("stage") != league_stage)).distinct()
    stages = constants(matches, ["stage", "stage_order"], stage_order)
    stages = stages.withColumn("stage_order", F.col("stage_order").cast("int"))

    def role(side: str) -> DataFrame:
        return teams.select(
            F.col("team_id").alias(f"{side}_team_id"),
            F.col("team_name").alias(f"{side}_team_name"),
            F.col("logo_url").alias(f"{side}_team_logo_url"),
        )

    return (
        played.join(F.broadcast(stages), "stage", "left")
        .join(competitions.select("competition_id", "competition_name"), "competition_id", "left")
        .join(role("home"), "home_team_id", "left")
        .join(role("away"), "away_team_id", "left")
        .withColumnRenamed("stage", "match_stage")
        .orderBy(F.col("stage_order").asc_nulls_last(), "match_at", "match_id")
    )


def orphans(facts: DataFrame, dimension: DataFrame, key: str, dimension_key: str) -> DataFrame:
    """Rows whose key is set but missing from the dimension; keys are compared as text.

    The dimension is reduced to its distinct keys, and a skewed fact key is split by adaptive
    execution, which may do so for an anti join.
    """
    known = dimension.select(F.col(dimension_key).cast("string").alias("__known")).distinct()
    present = facts.filter(F.col(key).isNotNull())
    return present.join(known, F.col(key).cast("string") == F.col("__known"), "left_anti")
