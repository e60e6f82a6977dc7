"""Versioned running statistics: each event closes the version before it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.keys import surrogate_key
from touchline.operators.grid import DayGrid, grid_left_join, number_of_points, points_within, weeks_of
from touchline.operators.ordered import Scan, following, ordered, ranked, running_count, running_sum
from touchline.operators.sides import SIDES, points_for, unpivot_sides
from touchline.operators.standings import counting, table_order

GROUP = ["team_id", "competition_id", "season_id"]
MATCH_LENGTH = "INTERVAL 120 MINUTES"
OUTCOMES = {"win": "wins", "draw": "draws", "loss": "losses"}


def versions(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    running: Mapping[str, Scan],
    ties: Sequence[str] = (),
    start: str = "version_start_at",
    end: str = "version_end_at",
    **limits,
) -> DataFrame:
    """Each row becomes a version valid from ``at`` until the next row of its group.

    The last version stays open (NULL end). ``running`` adds values accumulated over the
    group's history; end and all running values come from one sort of the group.
    """
    order = [F.col(at).asc_nulls_last(), *[F.col(tie).asc_nulls_last() for tie in ties]]
    scans = ordered(df, keys, order, **limits).scan(**{end: following(at)}, **running)
    return scans.rows.withColumnRenamed(at, start)


def standings_versions(
    matches: DataFrame,
    teams: DataFrame,
    competitions: DataFrame,
    seasons: DataFrame,
    separator: str = "",
    **limits,
) -> DataFrame:
    """State of each team after each match of its season: 9 match and 13 running statistics."""
    scores = counting(matches).withColumnsRenamed(
        {"full_time_home_score": "home_goals", "full_time_away_score": "away_goals"}
    )
    sides = unpivot_sides(scores, ["team_id", "goals"], "venue", ["match_id", "competition_id", "season_id", "match_at"])
    scored, conceded = F.col("goals"), F.col("opponent_goals")
    outcome = F.when(scored > conceded, "win").when(scored == conceded, "draw").when(scored < conceded, "loss")
    points = F.col("match_pts")

    def at_venue(venue: str, value: Column) -> Column:
        return F.when(F.col("venue") == venue, value).otherwise(0)

    def flag(result: str) -> Column:
        return F.coalesce(F.col("outcome") == result, F.lit(False))

    per_match = {
        **{f"version_{venue}_pts": at_venue(venue, points) for venue in SIDES},
        "version_total_pts": points,
        "version_number_of_goals_scored": scored,
        "version_number_of_goals_conceded": conceded,
        "version_total_number_of_goals_in_match": scored + conceded,
        **{f"version_number_of_{many}": flag(one).cast("int") for one, many in OUTCOMES.items()},
    }
    running = {
        **{f"running_number_of_{many}": running_count(flag(one)) for one, many in OUTCOMES.items()},
        **{f"running_{venue}_pts": running_sum(at_venue(venue, points)) for venue in SIDES},
        "running_total_pts": running_sum(points),
        "running_number_of_goals_scored": running_sum(scored),
        "running_number_of_goals_conceded": running_sum(conceded),
        "running_total_number_of_goals_in_matches": running_sum(scored + conceded),
    }
    for venue, suffix in {"home": "at_home", "away": "away"}.items():
        running[f"running_number_of_goals_scored_{suffix}"] = running_sum(at_venue(venue, scored))
        running[f"running_number_of_goals_conceded_{suffix}"] = running_sum(at_venue(venue, conceded))

    rows = (
        sides.withColumn("outcome", outcome)
        .withColumn("match_pts", points_for(F.col("outcome")))
        .withColumn("ended_at", F.col("match_at") + F.expr(MATCH_LENGTH))
    )
    history = versions(rows, GROUP, "ended_at", running, ties=["match_id", "venue"], **limits)
    history = history.withColumns(per_match)
    key = surrogate_key("standings_version", "version_start_at", "team_id", "competition_id", separator=separator)
    named = (
        history.withColumn("standings_version_id", key)
        .join(teams.select("team_id", "team_name", F.col("logo_url").alias("team_logo_url")), "team_id", "left")
        .join(competitions.select("competition_id", "competition_name"), "competition_id", "left")
        .join(seasons.select("season_id", "season_name"), "season_id", "left")
    )
    return named.drop("venue", "goals", "opponent_goals", "outcome", "match_pts", "match_at", "opponent_team_id")


def with_open_end(history: DataFrame, length: str = "INTERVAL 7 DAYS") -> DataFrame:
    """Give the open version of each group an end, ``length`` after its start.

    Versions of a group follow one another, so the open one is simply the one without end.
    """
    end = F.coalesce("version_end_at", F.col("version_start_at") + F.expr(length))
    return history.withColumn("version_end_at", end)


def sizes_at_points(history: DataFrame, points: Column, versions_per_point: int = 1) -> DataFrame:
    """Upper bound on the rows of a competition at one grid point, and all its rows together.

    Versions of one group do not overlap, so a point sees at most one of each: the bound is the
    number of groups in the competition. ``points`` is the number of points a version holds.
    Nothing is exploded for either.
    """
    groups = history.groupBy(*GROUP).agg(F.sum(points).alias("points"))
    bound = (F.count(F.lit(1)) * versions_per_point).alias("rows")
    return groups.groupBy("competition_id").agg(bound, F.sum("points").alias("total"))


def weekly_standings(history: DataFrame, grid: DayGrid | None = None, **limits) -> DataFrame:
    """Every table as it stood at each grid point, ranked; points without any table stay.

    The grid is that of all weeks of the history unless another one is given.
    """
    closed = with_open_end(history)
    if grid is None:
        grid = weeks_of(closed, "version_start_at", "version_end_at")
    at_points = grid_left_join(closed, grid, "week_start_date", "version_start_at", "version_end_at")
    order = [
        *table_order("running_total_pts", "running_number_of_goals_scored", "running_number_of_goals_conceded"),
        *[F.col(name).asc_nulls_last() for name in ("team_id", "season_id", "match_id")],
    ]
    sizes = sizes_at_points(closed, number_of_points(grid, "version_start_at", "version_end_at"))
    return ranked(at_points, ["week_start_date", "competition_id"], order, sizes=sizes, **limits)


def ranked_at_week_ends(history: DataFrame, grid: DayGrid | None = None, **limits) -> DataFrame:
    """The closed variant: versions that hold a week's last day, both ends included, by points.

    The open version has no end and holds no day; weeks without a version are left out.
    """
    if grid is None:
        grid = weeks_of(history, "version_start_at", "version_end_at", day=6)
    at_points = points_within(history, grid, "week_end_date", "version_start_at", "version_end_at", closed=True)
    start = F.col("week_end_date") - F.expr("INTERVAL 6 DAYS")
    order = [F.col("running_total_pts").desc_nulls_last()]
    order += [F.col(name).asc_nulls_last() for name in ("team_id", "season_id", "match_id")]
    # with both ends included two versions of a group can meet in a point
    points = number_of_points(grid, "version_start_at", "version_end_at", closed=True)
    sizes = sizes_at_points(history, points, versions_per_point=2)
    places = ranked(at_points, ["week_end_date", "competition_id"], order, sizes=sizes, **limits)
    return places.withColumn("week_start_date", start)
