"""Two-sided facts as one row per side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.dates import month_start
from touchline.functions.keys import surrogate_key

HOME, AWAY = "home", "away"
SIDES = (HOME, AWAY)


def result_for(side: Column, winner: Column) -> Column:
    """win, draw or loss of a side; NULL while there is no winner."""
    return F.when(winner == "draw", "draw").when(side == winner, "win").when(side != winner, "loss")


def points_for(result: Column, win: int = 3, draw: int = 1) -> Column:
    return F.when(result == "win", win).when(result == "draw", draw).when(result == "loss", 0)


def unpivot_sides(df: DataFrame, per_side: Sequence[str], side: str = "side", keep: Sequence[str] = ()) -> DataFrame:
    """``home_x`` and ``away_x`` columns -> two rows with ``x`` and ``opponent_x``.

    One scan: each row is exploded into an array of two structs. Two filtered branches with a
    union would read and shuffle the input twice.
    """

    def half(own: str, other: str) -> Column:
        return F.struct(
            F.lit(own).alias(side),
            *[F.col(f"{own}_{name}").alias(name) for name in per_side],
            *[F.col(f"{other}_{name}").alias(f"opponent_{name}") for name in per_side],
        )

    halves = F.explode(F.array(half(HOME, AWAY), half(AWAY, HOME))).alias("__half")
    return df.select(*keep, halves).select(*keep, "__half.*")


def union_sides(df: DataFrame, per_side: Sequence[str], side: str = "side", keep: Sequence[str] = ()) -> DataFrame:
    """The own columns of :func:`unpivot_sides`, written as a UNION ALL of two branches."""
    branches = [
        df.select(*keep, F.lit(own).alias(side), *[F.col(f"{own}_{name}").alias(name) for name in per_side])
        for own in SIDES
    ]
    return branches[0].unionByName(branches[1])


def per_side(matches: DataFrame, extra: Sequence[str] = (), separator: str = "", distinct: bool = False) -> DataFrame:
    """One row per match and team, with the team's result.

    ``matches`` has one row per ``match_id``; where it might not, ``distinct`` drops whole-row
    duplicates for the price of a shuffle. ``extra`` columns are carried along.
    """
    keep = ["match_id", "competition_id", "match_at", "status", "stage", "winner", *extra]
    sides = unpivot_sides(matches, ["team_id"], "team_playing_location", keep)
    rows = sides.select(
        surrogate_key("match", "team_id", "match_id", separator=separator).alias("team_match_id"),
        "match_id",
        "competition_id",
        "team_id",
        "team_playing_location",
        "match_at",
        F.col("status").alias("match_status"),
        F.col("stage").alias("match_stage"),
        result_for(F.col("team_playing_location"), F.col("winner")).alias("team_result"),
        *extra,
    )
    return rows.distinct() if distinct else rows


def other_side(df: DataFrame, match: str = "match_id", team: str = "team_id", name: str = "opponent_team_id") -> DataFrame:
    """Add the other team of the match to rows that are already one per side.

    The self join on ``match`` with ``team <> team`` is replaced by the two teams of each match
    (combined map-side) and one equi join. A match has two sides; with one team, or no match
    id, the other is NULL.
    """
    known = df.filter(F.col(match).isNotNull() & F.col(team).isNotNull())
    pairs = known.groupBy(F.col(match).alias("__match")).agg(F.min(team).alias("__low"), F.max(team).alias("__high"))
    other = F.when(F.col(team) == F.col("__low"), F.col("__high")).otherwise(F.col("__low"))
    return (
        df.join(pairs, F.col(match) == F.col("__match"), "left")
        .withColumn(name, F.when(F.col(team) != other, other))
        .drop("__match", "__low", "__high")
    )


def match_facts(
    matches: DataFrame,
    teams: DataFrame,
    competitions: DataFrame,
    no_points: Column | None = None,
    separator: str = "",
) -> DataFrame:
    """Per team and match: result, points by venue, goals for and against, opponent.

    Points count for finished matches. ``no_points`` marks matches outside any table (their
    points are NULL). The opponent comes from the match row itself, so neither a join back to
    the scores nor a self join is needed; the dimensions are the only joins.
    """
    scores = matches.withColumnsRenamed(
        {"full_time_home_score": "home_goals", "full_time_away_score": "away_goals"}
    )
    keep = ["match_id", "competition_id", "match_at", "status", "stage", "winner"]
    sides = unpivot_sides(scores, ["team_id", "goals"], "team_playing_location", keep)
    sides = sides.withColumn("team_result", result_for(F.col("team_playing_location"), F.col("winner")))

    outside = F.lit(False) if no_points is None else F.coalesce(no_points, F.lit(False))
    points = F.when(F.col("status") == "finished", points_for(F.col("team_result")))
    at = {venue: F.when(F.col("team_playing_location") == venue, points) for venue in SIDES}
    different = F.col("team_id") != F.col("opponent_team_id")

    facts = sides.select(
        surrogate_key("match", "team_id", "match_id", separator=separator).alias("team_match_id"),
        "match_id",
        "competition_id",
        "team_id",
        "team_playing_location",
        "match_at",
        month_start("match_at").alias("match_month"),
        "team_result",
        F.col("status").alias("match_status"),
        F.col("stage").alias("match_stage"),
        F.when(different, F.col("opponent_team_id")).alias("opponent_team_id"),
        *[F.when(~outside, F.coalesce(at[v], F.lit(0))).cast("int").alias(f"{v}_pts") for v in SIDES],
        F.when(~outside, points).cast("int").alias("total_pts"),
        F.col("goals").alias("goals_scored"),
        F.col("opponent_goals").alias("goals_conceded"),
    )
    own = teams.select("team_id", "team_name", F.col("logo_url").alias("team_logo_url"))
    opponents = teams.select(
        F.col("team_id").alias("opponent_team_id"),
        F.col("team_name").alias("opponent_team_name"),
        F.col("logo_url").alias("opponent_team_logo_url"),
    )
    return (
        facts.join(own, "team_id", "left")
        .join(competitions.select("competition_id", "competition_name"), "competition_id", "left")
        .join(opponents, "opponent_team_id", "left")
    )
