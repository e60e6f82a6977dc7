"""Streaks: uninterrupted runs of one result (gaps and islands)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.keys import surrogate_key
from touchline.operators.ordered import following, ordered, previous, row_number, running_max, running_sum

def streak_members(
    df: DataFrame, keys: Sequence[str], at: str, value: str, member: str, **limits
) -> DataFrame:
    """Every row with the number of its streak, its position in it, and whether its group ends here.

    A streak ends where ``value`` changes; a NULL value is a streak of its own each time, as is
    the row after it. Rows are ordered by ``at``, then ``member``.
    """
    order = [F.col(at).asc_nulls_last(), F.col(member).asc_nulls_last()]
    rows = ordered(df, keys, order, **limits).scan(
        __before=previous(value), __after=following(F.lit(True)), __place=row_number()
    )
    starts = F.coalesce(F.col("__before") != F.col(value), F.lit(True))
    rows = rows.with_columns(__starts=starts, is_last=F.col("__after").isNull())
    # same groups and order as above: no further shuffle or sort
    rows = rows.scan(
        streak_number=running_sum(F.col("__starts").cast("int")),
        __start_place=running_max(F.when(F.col("__starts"), F.col("__place"))),
    )
    position = (F.col("__place") - F.col("__start_place") + 1).alias("position")
    return rows.rows.select(*df.columns, "streak_number", position, "is_last")


def streaks(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    value: str,
    member: str,
    *,
    endpoints: str = "text",
    after_last: str = "INTERVAL 120 MINUTES",
    lists: bool = False,
    **limits,
) -> DataFrame:
    """One row per streak: type, length, first and last member, start, end, lists of members.

    The end is ``after_last`` past the last row, or NULL while the streak is the group's latest.
    ``endpoints="text"`` takes the smallest and largest member id as first and last;
    ``endpoints="time"`` takes the members played first and last.

    All of it is made of mergeable aggregates. ``lists`` adds all members and their times in time
    order, one row holding a whole streak; :func:`streak_members` has the members as rows instead.
    """
    members = streak_members(df, keys, at, value, member, **limits)
    if endpoints == "time":
        first, last = F.min_by(member, "position"), F.max_by(member, "position")
    else:
        first, last = F.min(member), F.max(member)
    collected = []
    if lists:
        item = F.struct(F.col("position"), F.col(member).alias("id"), F.col(at).alias("at"))
        collected = [F.sort_array(F.collect_list(item)).alias("__members")]
    found = members.groupBy(*keys, "streak_number").agg(
        F.count(member).alias("number_of_members"),
        F.min(value).alias("streak_type"),
        first.alias("first_member"),
        last.alias("last_member"),
        F.min(at).alias("start_at"),
        F.when(~F.bool_or("is_last"), F.max(at) + F.expr(after_last)).alias("end_at"),
        *collected,
    )
    if lists:
        found = found.withColumns({"members": F.col("__members.id"), "member_times": F.col("__members.at")})
    return found.drop("__members")


def team_streaks(
    sides: DataFrame,
    teams: DataFrame,
    competitions: DataFrame,
    separator: str = "",
    endpoints: str = "text",
    **limits,
) -> DataFrame:
    """Win, draw and loss streaks of each team in each competition, over its finished matches."""
    finished = sides.filter(F.col("match_status") == "finished").select(
        "team_id", "competition_id", "match_id", "match_at", "team_result"
    )
    found = streaks(
        finished, ["team_id", "competition_id"], "match_at", "team_result", "match_id", endpoints=endpoints, lists=True, **limits
    )
    key = surrogate_key("streak", "competition_id", "team_id", "streak_number", separator=separator)
    return (
        found.join(competitions.select("competition_id", "competition_name"), "competition_id", "left")
        .join(teams.select("team_id", "team_name", F.col("logo_url").alias("team_logo_url")), "team_id", "left")
        .select(
            key.alias("streak_id"),
            "competition_id",
            "competition_name",
            "team_id",
            "team_name",
            "team_logo_url",
            F.col("members").alias("streak_match_ids"),
            F.col("member_times").alias("streak_match_ats"),
            F.col("number_of_members").alias("streak_number_of_matches"),
            "streak_type",
            F.col("first_member").alias("streak_start_match_id"),
            F.col("last_member").alias("streak_end_match_id"),
            F.col("start_at").alias("streak_start_at"),
            F.col("end_at").alias("streak_end_at"),
        )
    )


def ongoing(found: DataFrame, end: str = "streak_end_at") -> DataFrame:
    """The streaks that have not ended."""
    return found.filter(F.col(end).isNull())


