"""League tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.keys import surrogate_key
from touchline.operators.ordered import ranked
from touchline.operators.sides import SIDES, points_for, result_for, unpivot_sides

COUNTING_STATUSES = ("finished", "awarded")
TABLE_STAGES = ("regular season", "league stage")

KEYS = ["team_id", "competition_id"]


def counting(matches: DataFrame, stages: Sequence[str] = TABLE_STAGES) -> DataFrame:
    """Matches that count for a table: a result stands, and it is no knockout match."""
    return matches.filter(F.col("status").isin(*COUNTING_STATUSES) & F.col("stage").isin(*stages))


def table_order(points: str, scored: str, conceded: str) -> list[Column]:
    """Points, then goal difference, then goals scored; unknown values last."""
    return [
        F.col(points).desc_nulls_last(),
        (F.col(scored) - F.col(conceded)).desc_nulls_last(),
        F.col(scored).desc_nulls_last(),
    ]


def venue_totals(matches: DataFrame) -> DataFrame:
    """Sums and counts of each team in each competition, apart for home and away.

    A single pass: the two sides of a match become two rows, and one map-side combined
    aggregate fills the columns of both venues. Points follow ``winner``; wins, draws and
    losses follow the scores.
    """
    scores = matches.withColumnsRenamed(
        {"full_time_home_score": "home_goals", "full_time_away_score": "away_goals"}
    )
    sides = unpivot_sides(scores, ["team_id", "goals"], "venue", ["competition_id", "winner"])
    points = points_for(result_for(F.col("venue"), F.col("winner")))
    goals, against = F.col("goals"), F.col("opponent_goals")
    columns = []
    for venue in SIDES:
        here = F.col("venue") == venue
        columns += [
            F.sum(F.when(here, points)).alias(f"{venue}_pts"),
            F.sum(F.when(here, goals)).alias(f"{venue}_scored"),
            F.sum(F.when(here, against)).alias(f"{venue}_conceded"),
            F.count_if(here).alias(f"{venue}_rows"),
            F.count_if(here & F.col("team_id").isNotNull()).alias(f"{venue}_matches"),
            F.count_if(here & (goals > against)).alias(f"{venue}_wins"),
            F.count_if(here & (goals == against)).alias(f"{venue}_draws"),
            F.count_if(here & (goals < against)).alias(f"{venue}_losses"),
        ]
    return sides.groupBy(*KEYS).agg(*columns)


def _table(totals: DataFrame) -> DataFrame:
    def both(name: str) -> Column:
        return F.col(f"home_{name}") + F.col(f"away_{name}")

    return totals.select(
        *KEYS,
        "home_pts",
        "away_pts",
        both("pts").alias("total_pts"),
        F.col("home_matches").alias("number_of_home_matches"),
        F.col("away_matches").alias("number_of_away_matches"),
        both("matches").alias("total_number_of_matches"),
        F.col("home_scored").alias("goals_scored_at_home"),
        F.col("home_conceded").alias("goals_conceded_at_home"),
        F.col("away_scored").alias("goals_scored_away"),
        F.col("away_conceded").alias("goals_conceded_away"),
        both("scored").alias("total_goals_scored"),
        both("conceded").alias("total_goals_conceded"),
        *[
            F.col(f"{venue}_{outcome}").alias(f"number_of_{venue}_{outcome}")
            for venue in SIDES
            for outcome in ("wins", "draws", "losses")
        ],
        *[both(outcome).alias(f"number_of_{outcome}") for outcome in ("wins", "draws", "losses")],
    )


def _placed(table: DataFrame, **limits) -> DataFrame:
    order = [*table_order("total_pts", "total_goals_scored", "total_goals_conceded"), F.col("team_id").asc_nulls_last()]
    # one row per team and competition: small next to the matches, so written once and reused
    return ranked(table, ["competition_id"], order, reuse=True, **limits)


def standings(matches: DataFrame, **limits) -> DataFrame:
    """Table of each competition: teams with a home match, ranked.

    As home totals left-joined with away totals would give: a team without away matches has
    NULL away and total columns, a team without home matches is missing.
    :func:`full_standings` keeps both.
    """
    totals = venue_totals(counting(matches)).filter("home_rows > 0")
    joined = (F.col("away_rows") > 0) & F.col("team_id").isNotNull() & F.col("competition_id").isNotNull()
    away = [name for name in totals.columns if name.startswith("away_") and name != "away_rows"]
    totals = totals.withColumns({name: F.when(joined, F.col(name)) for name in away})
    return _placed(_table(totals), **limits)


def full_standings(matches: DataFrame, **limits) -> DataFrame:
    """As :func:`standings`, but every team is kept and missing sums count as 0."""
    totals = venue_totals(counting(matches))
    return _placed(_table(totals.fillna(0, [n for n in totals.columns if n not in KEYS])), **limits)


def with_placement(table: DataFrame, teams: DataFrame, competitions: DataFrame, separator: str = "") -> DataFrame:
    """Add the placement key and the names of team and competition."""
    names = teams.select("team_id", "team_name", F.col("logo_url").alias("team_logo_url"))
    key = surrogate_key("current_placement", "team_id", "competition_id", separator=separator)
    return (
        table.withColumn("current_placement_id", key)
        .join(names, "team_id", "left")
        .join(competitions.select("competition_id", "competition_name"), "competition_id", "left")
    )


def points_by_venue(matches: DataFrame, teams: DataFrame, competition_id: str) -> DataFrame:
    """Home, away and total points of the teams of one competition, best first.

    Every match counts, and one without a winner counts as a draw. A team missing at one venue
    has NULL there and in total. One conditional aggregate serves both venues.
    """
    played = matches.filter(F.col("competition_id") == competition_id)
    sides = unpivot_sides(played, ["team_id"], "venue", ["winner"])
    points = F.coalesce(points_for(result_for(F.col("venue"), F.col("winner"))), F.lit(1))
    totals = sides.groupBy("team_id").agg(
        *[F.sum(F.when(F.col("venue") == venue, points)).alias(f"{venue}_pts") for venue in SIDES]
    )
    members = teams.filter(F.col("main_competition_id") == competition_id).select("team_id", "team_short_name")
    total = (F.col("home_pts") + F.col("away_pts")).alias("total_pts")
    return (
        members.join(totals, "team_id", "left")
        .select("team_id", "team_short_name", "home_pts", "away_pts", total)
        .orderBy(F.col("total_pts").desc_nulls_last(), "team_id")
    )
