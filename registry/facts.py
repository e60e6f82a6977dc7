"""Sides, match facts, tables, versions, snapshots and streaks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import derived as d
from registry.register import Entry, table, with_sql
from touchline.operators import dims, sides, standings, streaks, versions
from touchline.operators.grid import days_of, grid_left_join, points_within
from touchline.operators.ordered import ranked, row_number, running_sum
from touchline.plans import contracts
from touchline.plans import values as v
from touchline.plans.warehouse import no_points
from touchline.sources.tables import scratch_table


# --- two rows per match ----------------------------------------------------------------------


def per_side(spark: SparkSession, folder: str) -> DataFrame:
    return sides.per_side(d.matches(spark, folder)).select(*contracts.MATCHES_PER_TEAM)


PER_SIDE = with_sql(
    d.SQL_MATCHES,
    d.SQL_SIDES,
    """SELECT 'match_' || md5(team_id || match_id) AS team_match_id, match_id, competition_id, team_id,
              venue AS team_playing_location, match_at, status AS match_status, stage AS match_stage,
              result AS team_result
       FROM sides""",
)


def per_side_distinct(spark: SparkSession, folder: str) -> DataFrame:
    """Duplicate match rows, with a separator in the key."""
    matches = d.matches(spark, folder)
    twice = matches.unionByName(matches.filter("status = 'finished'"))
    return sides.per_side(twice, separator="|", distinct=True).select(*contracts.MATCHES_PER_TEAM)


PER_SIDE_DISTINCT = PER_SIDE.replace("md5(team_id || match_id)", "md5(team_id || '|' || match_id)")


def union_sides(spark: SparkSession, folder: str) -> DataFrame:
    return sides.union_sides(d.matches(spark, folder), ["team_id"], "team_playing_location", ["match_id", "match_at"])


UNION_SIDES = with_sql(
    d.SQL_MATCHES,
    """SELECT match_id, match_at, 'home' AS team_playing_location, home_team_id AS team_id FROM matches
       UNION ALL
       SELECT match_id, match_at, 'away', away_team_id FROM matches""",
)


def opponents(spark: SparkSession, folder: str) -> DataFrame:
    rows = sides.union_sides(d.matches(spark, folder), ["team_id"], "venue", ["match_id"])
    return sides.other_side(rows)


OPPONENTS = with_sql(
    d.SQL_MATCHES,
    d.SQL_SIDES,
    """SELECT mine.match_id, mine.venue, mine.team_id, other.team_id AS opponent_team_id
       FROM sides AS mine LEFT JOIN sides AS other
         ON other.match_id = mine.match_id AND other.team_id <> mine.team_id""",
)


def match_facts(spark: SparkSession, folder: str) -> DataFrame:
    facts = sides.match_facts(
        d.matches(spark, folder), d.teams(spark, folder), d.competitions(spark, folder), no_points()
    )
    return facts.select(*contracts.MATCH_FACTS)


MATCH_FACTS_PARTS = [
    """scored AS (
         SELECT *, competition_id = '2001' AND stage <> 'league stage' AS knockout,
                CASE WHEN status = 'finished' THEN
                  CASE result WHEN 'win' THEN 3 WHEN 'draw' THEN 1 WHEN 'loss' THEN 0 END END AS pts
         FROM sides)""",
    """SELECT 'match_' || md5(s.team_id || match_id) AS team_match_id, match_id, s.competition_id,
              competition_name, s.team_id, t.team_name, t.logo_url AS team_logo_url,
              venue AS team_playing_location, match_at,
              CAST(date_trunc('month', match_at) AS TIMESTAMP) AS match_month, result AS team_result,
              status AS match_status, stage AS match_stage, opponent_id AS opponent_team_id,
              o.team_name AS opponent_team_name, o.logo_url AS opponent_team_logo_url,
              CAST(CASE WHEN knockout THEN NULL WHEN venue = 'home' THEN coalesce(pts, 0) ELSE 0 END AS INTEGER)
                AS home_pts,
              CAST(CASE WHEN knockout THEN NULL WHEN venue = 'away' THEN coalesce(pts, 0) ELSE 0 END AS INTEGER)
                AS away_pts,
              CAST(CASE WHEN NOT knockout THEN pts END AS INTEGER) AS total_pts,
              goals AS goals_scored, against AS goals_conceded
       FROM scored AS s
       LEFT JOIN teams AS t ON t.team_id = s.team_id
       LEFT JOIN teams AS o ON o.team_id = s.opponent_id
       LEFT JOIN competitions AS c ON c.competition_id = s.competition_id""",
]
MATCH_FACTS = with_sql(
    d.SQL_MATCHES,
    d.SQL_SIDES,
    d.SQL_TEAMS,
    d.SQL_COMPETITIONS,
    *MATCH_FACTS_PARTS,
)


# --- tables ----------------------------------------------------------------------------------


def standings_current(spark: SparkSession, folder: str) -> DataFrame:
    table_now = standings.standings(d.matches(spark, folder))
    named = standings.with_placement(table_now, d.teams(spark, folder), d.competitions(spark, folder))
    return named.select(*contracts.STANDINGS)


_VENUES = """venues AS (
  SELECT team_id, competition_id, venue, CAST(sum(CASE result WHEN 'win' THEN 3 WHEN 'draw' THEN 1 ELSE 0 END) AS BIGINT) AS pts,
         CAST(sum(goals) AS BIGINT) AS scored, CAST(sum(against) AS BIGINT) AS conceded, count(*) AS played,
         count(*) FILTER (goals > against) AS wins, count(*) FILTER (goals = against) AS draws,
         count(*) FILTER (goals < against) AS losses
  FROM sides
  WHERE status IN ('finished', 'awarded') AND stage IN ('regular season', 'league stage')
  GROUP BY team_id, competition_id, venue)"""

_STANDINGS_SELECT = """
  SELECT 'current_placement_' || md5(team_id || competition_id) AS current_placement_id,
         row_number() OVER (PARTITION BY competition_id
           ORDER BY {h}.pts + {a}.pts DESC NULLS LAST,
                    {h}.scored + {a}.scored - ({h}.conceded + {a}.conceded) DESC NULLS LAST,
                    {h}.scored + {a}.scored DESC NULLS LAST, team_id) AS ranking,
         competition_name, competition_id, team_name, logo_url AS team_logo_url, team_id,
         {h}.pts AS home_pts, {a}.pts AS away_pts, {h}.pts + {a}.pts AS total_pts,
         {h}.played AS number_of_home_matches, {a}.played AS number_of_away_matches,
         {h}.played + {a}.played AS total_number_of_matches,
         {h}.scored AS goals_scored_at_home, {h}.conceded AS goals_conceded_at_home,
         {a}.scored AS goals_scored_away, {a}.conceded AS goals_conceded_away,
         {h}.scored + {a}.scored AS total_goals_scored, {h}.conceded + {a}.conceded AS total_goals_conceded,
         {h}.wins AS number_of_home_wins, {h}.draws AS number_of_home_draws, {h}.losses AS number_of_home_losses,
         {a}.wins AS number_of_away_wins, {a}.draws AS number_of_away_draws, {a}.losses AS number_of_away_losses,
         {h}.wins + {a}.wins AS number_of_wins, {h}.draws + {a}.draws AS number_of_draws,
         {h}.losses + {a}.losses AS number_of_losses
"""

STANDINGS_PARTS = [
    _VENUES,
    _STANDINGS_SELECT.format(h="home", a="away")
    + """FROM (FROM venues WHERE venue = 'home') AS home
         LEFT JOIN (FROM venues WHERE venue = 'away') AS away USING (team_id, competition_id)
         LEFT JOIN teams USING (team_id)
         LEFT JOIN competitions USING (competition_id)""",
]
STANDINGS_CURRENT = with_sql(
    d.SQL_MATCHES,
    d.SQL_SIDES,
    d.SQL_TEAMS,
    d.SQL_COMPETITIONS,
    *STANDINGS_PARTS,
)


def standings_full(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as home teams, suppliers as away teams: many teams play at one venue only."""
    return standings.full_standings(_one_sided(spark, folder))


def _one_sided(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    lines = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("supplier"), F.count(F.lit(1)).cast("int").alias("n")
    )
    shift = (F.col("o_orderkey") % 3).cast("int")
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.lit("finished").alias("status"),
        F.lit("regular season").alias("stage"),
        d.competition_number().cast("string").alias("competition_id"),
        F.col("o_custkey").cast("string").alias("home_team_id"),
        F.col("supplier").cast("string").alias("away_team_id"),
        F.when(F.col("n") > shift + 2, "home").when(F.col("n") < shift + 2, "away").otherwise("draw").alias("winner"),
        F.col("n").alias("full_time_home_score"),
        (shift + 2).alias("full_time_away_score"),
    )


_ONE_SIDED = f"""sides AS (
  SELECT 'finished' AS status, 'regular season' AS stage, v.*,
         CAST({d.SQL_COMPETITION} AS VARCHAR) AS competition_id,
         CASE WHEN goals > against THEN 'win' WHEN goals = against THEN 'draw' ELSE 'loss' END AS result
  FROM orders
  JOIN (SELECT l_orderkey, min(l_suppkey) AS supplier, count(*) AS n FROM lineitem GROUP BY l_orderkey) AS line
    ON l_orderkey = o_orderkey,
  LATERAL (VALUES ('home', CAST(o_custkey AS VARCHAR), n, o_orderkey % 3 + 2),
                  ('away', CAST(supplier AS VARCHAR), o_orderkey % 3 + 2, n)) AS v(venue, team_id, goals, against))"""

_FULL = ", ".join(
    f"coalesce({side}.{name}, 0) AS {side}_{name}"
    for side in ("home", "away")
    for name in ("pts", "scored", "conceded", "played", "wins", "draws", "losses")
)

STANDINGS_FULL = with_sql(
    _ONE_SIDED,
    _VENUES,
    f"""both_venues AS (
          SELECT team_id, competition_id, {_FULL}
          FROM (FROM venues WHERE venue = 'home') AS home
          FULL JOIN (FROM venues WHERE venue = 'away') AS away USING (team_id, competition_id))""",
    "SELECT * EXCLUDE (current_placement_id, competition_name, team_name, team_logo_url) FROM ("
    + _STANDINGS_SELECT.replace("{h}.", "home_")
    .replace("{a}.", "away_")
    .replace("competition_name, competition_id", "NULL AS competition_name, competition_id")
    .replace("team_name, logo_url AS", "NULL AS team_name, NULL AS")
    .replace("home_pts AS home_pts", "home_pts")
    .replace("away_pts AS away_pts", "away_pts")
    + "FROM both_venues) AS t",
)


def standings_one_sided(spark: SparkSession, folder: str) -> DataFrame:
    """Teams without away matches have NULL totals, teams without home matches are missing."""
    return standings.standings(_one_sided(spark, folder))


STANDINGS_ONE_SIDED = with_sql(
    _ONE_SIDED,
    _VENUES,
    "SELECT * EXCLUDE (current_placement_id, competition_name, team_name, team_logo_url) FROM ("
    + _STANDINGS_SELECT.format(h="home", a="away")
    .replace("competition_name, competition_id", "NULL AS competition_name, competition_id")
    .replace("team_name, logo_url AS", "NULL AS team_name, NULL AS")
    + """FROM (FROM venues WHERE venue = 'home') AS home
         LEFT JOIN (FROM venues WHERE venue = 'away') AS away USING (team_id, competition_id)) AS t""",
)


def points_by_venue(spark: SparkSession, folder: str) -> DataFrame:
    return standings.points_by_venue(d.matches(spark, folder), d.teams(spark, folder), "2015")


POINTS_BY_VENUE = with_sql(
    d.SQL_MATCHES,
    d.SQL_SIDES,
    d.SQL_TEAMS,
    """SELECT t.team_id, team_short_name, h AS home_pts, a AS away_pts, h + a AS total_pts
       FROM teams AS t LEFT JOIN (
         SELECT team_id, CAST(sum(p) FILTER (venue = 'home') AS BIGINT) AS h,
                CAST(sum(p) FILTER (venue = 'away') AS BIGINT) AS a
         FROM (SELECT *, CASE result WHEN 'win' THEN 3 WHEN 'loss' THEN 0 ELSE 1 END AS p
               FROM sides WHERE competition_id = '2015') AS scored
         GROUP BY team_id) AS totals USING (team_id)
       WHERE main_competition_id = '2015'""",
)


# --- versions and snapshots ------------------------------------------------------------------


def _versions(spark: SparkSession, folder: str) -> DataFrame:
    seasons = dims.seasons(d.staged_seasons(spark, folder), d.competitions(spark, folder), [v.BRAZILIAN_LEAGUE])
    return versions.standings_versions(
        d.stored_matches(spark, folder), d.teams(spark, folder), d.competitions(spark, folder), seasons
    )


def standings_versions(spark: SparkSession, folder: str) -> DataFrame:
    return _versions(spark, folder).select(*contracts.VERSIONS)


def _running(expression: str, name: str) -> str:
    return f"CAST({expression} OVER history AS BIGINT) AS {name}"


_HISTORY = [d.SQL_MATCHES, d.SQL_SIDES, d.SQL_TEAMS, d.SQL_COMPETITIONS, d.SQL_SEASONS]
_HISTORY.append(
    """scored AS (
         SELECT *, match_at + INTERVAL 2 HOURS AS ended_at,
                CASE WHEN goals > against THEN 3 WHEN goals = against THEN 1 WHEN goals < against THEN 0 END AS pts
         FROM sides
         WHERE status IN ('finished', 'awarded') AND stage IN ('regular season', 'league stage'))"""
)
_RUNNING = ", ".join(
    [
        *[_running(f"count(*) FILTER (pts = {p})", f"running_number_of_{w}") for p, w in ((3, "wins"), (1, "draws"), (0, "losses"))],
        *[_running(f"sum(CASE WHEN venue = '{x}' THEN pts ELSE 0 END)", f"running_{x}_pts") for x in ("home", "away")],
        _running("sum(pts)", "running_total_pts"),
        _running("sum(goals)", "running_number_of_goals_scored"),
        _running("sum(against)", "running_number_of_goals_conceded"),
        _running("sum(goals + against)", "running_total_number_of_goals_in_matches"),
        *[
            _running(f"sum(CASE WHEN venue = '{x}' THEN {g} ELSE 0 END)", f"running_number_of_goals_{n}_{at}")
            for x, at in (("home", "at_home"), ("away", "away"))
            for g, n in (("goals", "scored"), ("against", "conceded"))
        ],
    ]
)
_HISTORY.append(
    f"""history AS (
         SELECT 'standings_version_' || md5(CAST(ended_at AS VARCHAR) || s.team_id || s.competition_id)
                  AS standings_version_id,
                match_id, ended_at AS version_start_at, lead(ended_at) OVER history AS version_end_at,
                s.team_id, team_name, logo_url AS team_logo_url, s.competition_id, c.competition_name,
                s.season_id, season_name,
                CAST(coalesce(pts = 3, false) AS INTEGER) AS version_number_of_wins,
                CAST(coalesce(pts = 1, false) AS INTEGER) AS version_number_of_draws,
                CAST(coalesce(pts = 0, false) AS INTEGER) AS version_number_of_losses,
                CASE venue WHEN 'home' THEN pts ELSE 0 END AS version_home_pts,
                CASE venue WHEN 'away' THEN pts ELSE 0 END AS version_away_pts, pts AS version_total_pts,
                goals AS version_number_of_goals_scored, against AS version_number_of_goals_conceded,
                goals + against AS version_total_number_of_goals_in_match,
                {_RUNNING}
         FROM scored AS s
         LEFT JOIN teams AS t ON t.team_id = s.team_id
         LEFT JOIN competitions AS c ON c.competition_id = s.competition_id
         LEFT JOIN seasons ON seasons.season_id = s.season_id
         WINDOW history AS (PARTITION BY s.team_id, s.competition_id, s.season_id
                            ORDER BY ended_at, match_id, venue ROWS UNBOUNDED PRECEDING))"""
)

STANDINGS_VERSIONS = with_sql(*_HISTORY, "FROM history")

_TABLE_ORDER = """running_total_pts DESC NULLS LAST,
  running_number_of_goals_scored - running_number_of_goals_conceded DESC NULLS LAST,
  running_number_of_goals_scored DESC NULLS LAST, team_id, season_id, match_id"""


def weekly_rankings(spark: SparkSession, folder: str) -> DataFrame:
    # the history feeds the size check, the empty weeks and the snapshot: written once, read thrice
    history = scratch_table(_versions(spark, folder), "versions")
    weekly = versions.weekly_standings(history).select(*contracts.WEEKLY)
    return weekly.orderBy(F.col("week_start_date").desc())



def weekly_parts(first: str = "min(version_start_at)", last: str = "max(version_end_at)") -> list[str]:
    """The tables at the start of all weeks from that of ``first`` to that of ``last``."""
    return [
        """closed AS (
             SELECT * REPLACE (coalesce(version_end_at, version_start_at + INTERVAL 7 DAYS) AS version_end_at)
             FROM history)""",
        f"""SELECT week AS week_start_date, closed.* EXCLUDE (team_logo_url),
                   row_number() OVER (PARTITION BY week, competition_id ORDER BY {_TABLE_ORDER}) AS ranking
            FROM (SELECT unnest(generate_series(date_trunc('week', {first}),
                    date_trunc('week', {last}), INTERVAL 7 DAYS)) AS week FROM closed) AS weeks
            LEFT JOIN closed ON week >= version_start_at AND week < version_end_at""",
    ]

WEEKLY_RANKINGS = with_sql(*_HISTORY, *weekly_parts())


def week_end_rankings(spark: SparkSession, folder: str) -> DataFrame:
    history = scratch_table(_versions(spark, folder), "versions")
    ranked = versions.ranked_at_week_ends(history)
    return ranked.select(
        "week_start_date",
        "week_end_date",
        "competition_id",
        "team_name",
        "season_id",
        "running_home_pts",
        "running_away_pts",
        "running_total_pts",
        "ranking",
    ).orderBy("week_start_date", "competition_id", "ranking")


WEEK_END_RANKINGS = with_sql(
    *_HISTORY,
    """SELECT week_end - INTERVAL 6 DAYS AS week_start_date, week_end AS week_end_date, competition_id, team_name,
              season_id, running_home_pts, running_away_pts, running_total_pts,
              row_number() OVER (PARTITION BY competition_id, week_end
                ORDER BY running_total_pts DESC NULLS LAST, team_id, season_id, match_id) AS ranking
       FROM (SELECT unnest(generate_series(date_trunc('week', min(version_start_at)) + INTERVAL 6 DAYS,
               date_trunc('week', max(version_start_at)) + INTERVAL 6 DAYS, INTERVAL 7 DAYS)) AS week_end
             FROM history) AS weeks
       JOIN history ON week_end BETWEEN version_start_at AND version_end_at""",
)


# --- snapshots and streaks of events ---------------------------------------------------------


def _event_state(spark: SparkSession, folder: str) -> DataFrame:
    """Each user's event count and total after each event, valid until the next one."""
    cents = F.round(F.col("value") * 100).cast("bigint")
    events = table(spark, folder, "events").select("user_id", "event_id", "ts", "event_type", cents.alias("cents"))
    running = {"events_so_far": row_number(), "cents_so_far": running_sum("cents")}
    return versions.versions(events, ["user_id"], "ts", running, ["event_id"], "valid_from", "valid_to")


_EVENT_STATE = """state AS (
  SELECT user_id, event_id, event_type, CAST(round(value * 100) AS BIGINT) AS cents, ts AS valid_from,
         lead(ts) OVER history AS valid_to, row_number() OVER history AS events_so_far,
         CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER (history ROWS UNBOUNDED PRECEDING) AS BIGINT)
           AS cents_so_far
  FROM events WINDOW history AS (PARTITION BY user_id ORDER BY ts, event_id))"""


def event_versions(spark: SparkSession, folder: str) -> DataFrame:
    return _event_state(spark, folder)


EVENT_VERSIONS = with_sql(_EVENT_STATE, "FROM state")


def daily_event_state(spark: SparkSession, folder: str) -> DataFrame:
    state = _event_state(spark, folder).select("user_id", "valid_from", "valid_to", "events_so_far", "cents_so_far")
    days = days_of(table(spark, folder, "events"), "ts", "ts")
    return grid_left_join(state, days, "day", "valid_from", "valid_to")


DAILY_EVENT_STATE = with_sql(
    _EVENT_STATE,
    """SELECT day, user_id, valid_from, valid_to, events_so_far, cents_so_far
       FROM (SELECT unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)), INTERVAL 1 DAY)) AS day
             FROM events) AS days
       LEFT JOIN state ON day >= valid_from AND day < valid_to""",
)


def daily_event_leaders(spark: SparkSession, folder: str) -> DataFrame:
    """Users ranked by total at each midnight; the closed form of the range join."""
    state = _event_state(spark, folder).select("user_id", "valid_from", "valid_to", "cents_so_far")
    days = days_of(table(spark, folder, "events"), "ts", "ts")
    at_days = points_within(state, days, "day", "valid_from", "valid_to", closed=True)
    order = [F.col("cents_so_far").desc_nulls_last(), F.col("user_id"), F.col("valid_from")]
    return ranked(at_days, ["day"], order)


DAILY_EVENT_LEADERS = with_sql(
    _EVENT_STATE,
    """SELECT day, user_id, valid_from, valid_to, cents_so_far,
              row_number() OVER (PARTITION BY day ORDER BY cents_so_far DESC, user_id, valid_from) AS ranking
       FROM (SELECT unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)), INTERVAL 1 DAY)) AS day
             FROM events) AS days
       JOIN state ON day BETWEEN valid_from AND valid_to""",
)


def _readable(found: DataFrame) -> DataFrame:
    """Lists as text, which compares the same everywhere."""
    times = F.transform("streak_match_ats", lambda at: at.cast("string"))
    return found.withColumns(
        {"streak_match_ids": F.concat_ws(",", "streak_match_ids"), "streak_match_ats": F.concat_ws(",", times)}
    )


def _team_streaks(spark: SparkSession, folder: str, **options) -> DataFrame:
    rows = sides.per_side(d.stored_matches(spark, folder))
    return streaks.team_streaks(rows, d.teams(spark, folder), d.competitions(spark, folder), **options)


def team_streaks(spark: SparkSession, folder: str) -> DataFrame:
    return _readable(_team_streaks(spark, folder))


_ISLANDS = [
    d.SQL_MATCHES,
    d.SQL_SIDES,
    d.SQL_TEAMS,
    d.SQL_COMPETITIONS,
    """flagged AS (
         SELECT competition_id, team_id, match_id, match_at, result,
                coalesce(lag(result) OVER w <> result, true) AS fresh, lead(match_id) OVER w IS NULL AS newest
         FROM sides WHERE status = 'finished'
         WINDOW w AS (PARTITION BY team_id, competition_id ORDER BY match_at, match_id))""",
    """islands AS (
         SELECT *, sum(fresh::INT) OVER (PARTITION BY team_id, competition_id ORDER BY match_at, match_id
                                         ROWS UNBOUNDED PRECEDING) AS island
         FROM flagged)""",
]

_STREAK_SELECT = """
  SELECT 'streak_' || md5(CAST({key} AS VARCHAR)) AS streak_id, competition_id, competition_name, team_id, team_name,
         logo_url AS team_logo_url, string_agg(match_id, ',' ORDER BY match_at, match_id) AS streak_match_ids,
         string_agg(CAST(match_at AS VARCHAR), ',' ORDER BY match_at, match_id) AS streak_match_ats,
         count(match_id) AS streak_number_of_matches, min(result) AS streak_type,
         {first} AS streak_start_match_id, {last} AS streak_end_match_id, min(match_at) AS streak_start_at,
         CASE WHEN NOT bool_or(newest) THEN max(match_at) + INTERVAL 120 MINUTES END AS streak_end_at
  FROM islands LEFT JOIN teams USING (team_id) LEFT JOIN competitions USING (competition_id)
  GROUP BY competition_id, competition_name, team_id, team_name, logo_url, island
"""

TEAM_STREAKS = with_sql(
    *_ISLANDS,
    _STREAK_SELECT.format(
        key="competition_id || team_id || CAST(island AS BIGINT)", first="min(match_id)", last="max(match_id)"
    ),
)


def team_streaks_by_time(spark: SparkSession, folder: str) -> DataFrame:
    """First and last match by time, and keys with a separator."""
    return _readable(_team_streaks(spark, folder, separator="|", endpoints="time"))


TEAM_STREAKS_BY_TIME = with_sql(
    *_ISLANDS,
    _STREAK_SELECT.format(
        key="competition_id || '|' || team_id || '|' || CAST(island AS BIGINT)",
        first="first(match_id ORDER BY match_at, match_id)",
        last="last(match_id ORDER BY match_at, match_id)",
    ),
)


def streaks_ongoing(spark: SparkSession, folder: str) -> DataFrame:
    return streaks.ongoing(_readable(_team_streaks(spark, folder)))


STREAKS_ONGOING = f"SELECT * FROM ({TEAM_STREAKS}) AS found WHERE streak_end_at IS NULL"


def event_streaks(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of one event type of a user."""
    events = table(spark, folder, "events").select("user_id", "event_id", "ts", "event_type")
    return streaks.streaks(events, ["user_id"], "ts", "event_type", "event_id", endpoints="time", lists=False)


EVENT_STREAKS = """
  WITH numbered AS (
    SELECT *, row_number() OVER w AS n, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS k,
           max(ts) OVER (PARTITION BY user_id) AS newest
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
  SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY min(ts)) AS streak_number,
         count(*) AS number_of_members, event_type AS streak_type, arg_min(event_id, n) AS first_member,
         arg_max(event_id, n) AS last_member, min(ts) AS start_at,
         CASE WHEN max(ts) < any_value(newest) THEN max(ts) + INTERVAL 2 HOURS END AS end_at
  FROM numbered GROUP BY user_id, event_type, n - k
"""


def event_streak_members(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("user_id", "event_id", "ts", "event_type")
    return streaks.streak_members(events, ["user_id"], "ts", "event_type", "event_id")


EVENT_STREAK_MEMBERS = """
  WITH numbered AS (
    SELECT user_id, event_id, ts, event_type, row_number() OVER w AS n, lead(ts) OVER w IS NULL AS is_last,
           row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS k
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
  started AS (SELECT *, min(n) OVER (PARTITION BY user_id, event_type, n - k) AS first_n FROM numbered)
  SELECT user_id, event_id, ts, event_type, dense_rank() OVER (PARTITION BY user_id ORDER BY first_n) AS streak_number,
         n - first_n + 1 AS position, is_last
  FROM started
"""


# --- knockout listing ------------------------------------------------------------------------


def playoff_matches(spark: SparkSession, folder: str) -> DataFrame:
    return dims.playoff_matches(
        d.matches(spark, folder),
        d.teams(spark, folder),
        d.competitions(spark, folder),
        v.CHAMPIONS_LEAGUE,
        v.PLAYOFF_STAGE_ORDER,
    )


PLAYOFF_PARTS = [
    """SELECT m.* EXCLUDE (stage), stage AS match_stage, competition_name, h.team_name AS home_team_name,
              h.logo_url AS home_team_logo_url, a.team_name AS away_team_name, a.logo_url AS away_team_logo_url,
              CAST(list_position(['final', 'semi finals', 'quarter finals', 'last 16', 'playoffs'], stage) * 10
                   AS INTEGER) AS stage_order
       FROM matches AS m
       LEFT JOIN teams AS h ON h.team_id = m.home_team_id
       LEFT JOIN teams AS a ON a.team_id = m.away_team_id
       LEFT JOIN competitions USING (competition_id)
       WHERE m.competition_id = '2001' AND stage <> 'league stage'""",
]
PLAYOFF_MATCHES = with_sql(
    d.SQL_MATCHES,
    d.SQL_TEAMS,
    d.SQL_COMPETITIONS,
    *PLAYOFF_PARTS,
)


ENTRIES = {
    "per_side": Entry(per_side, PER_SIDE),
    "per_side_distinct": Entry(per_side_distinct, PER_SIDE_DISTINCT),
    "union_sides": Entry(union_sides, UNION_SIDES),
    "opponent_self_join": Entry(opponents, OPPONENTS),
    "match_facts": Entry(match_facts, MATCH_FACTS),
    "standings_current": Entry(standings_current, STANDINGS_CURRENT),
    "standings_one_sided": Entry(standings_one_sided, STANDINGS_ONE_SIDED),
    "standings_one_pass": Entry(standings_full, STANDINGS_FULL),
    "points_by_venue": Entry(points_by_venue, POINTS_BY_VENUE),
    "standings_versions": Entry(standings_versions, STANDINGS_VERSIONS),
    "weekly_rankings": Entry(weekly_rankings, WEEKLY_RANKINGS),
    "weekly_rankings_inclusive": Entry(week_end_rankings, WEEK_END_RANKINGS),
    "event_versions": Entry(event_versions, EVENT_VERSIONS),
    "daily_event_state": Entry(daily_event_state, DAILY_EVENT_STATE),
    "daily_event_leaders": Entry(daily_event_leaders, DAILY_EVENT_LEADERS),
    "streaks": Entry(team_streaks, TEAM_STREAKS),
    "streaks_by_time": Entry(team_streaks_by_time, TEAM_STREAKS_BY_TIME),
    "streak_current": Entry(streaks_ongoing, STREAKS_ONGOING),
    "event_streaks": Entry(event_streaks, EVENT_STREAKS),
    "event_streak_members": Entry(event_streak_members, EVENT_STREAK_MEMBERS),
    "playoff_matches": Entry(playoff_matches, PLAYOFF_MATCHES),
}
