"""The checks declared for the warehouse's tables.

Three are left out because they contradict others of the same table: points that should be
known exactly where they have to be unknown (knockout matches of the Champions League).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.operators.ordered import following
from touchline.operators.quality import (
    Check,
    accepted_range,
    accepted_values,
    equal_counts,
    expression_is_true,
    greater_than,
    length_between,
    length_equals,
    list_relationships,
    min_list_length,
    minimum_after,
    no_element_after,
    no_overlapping_periods,
    not_null,
    not_null_but_latest,
    relationships,
    run_checks,
    scan_is_true,
    unique,
    unique_combination,
)
from touchline.plans import values as v

KNOCKOUT = "competition_id = '2001' AND match_stage != 'league stage'"
DECIDED = "status IN ('finished', 'awarded')"


def known(*columns: str) -> list[Check]:
    return [not_null(column) for column in columns]


def key(*columns: str) -> list[Check]:
    return [check for column in columns for check in (unique(column), not_null(column))]


def between(low, high, *columns: str) -> list[Check]:
    return [accepted_range(column, low, high) for column in columns]


def names_of(tables: dict[str, DataFrame], table: str, *columns: str, field: str | None = None) -> list[Check]:
    """Known, and found in another table."""
    checks = known(*columns)
    return checks + [relationships(column, tables[table], field or column) for column in columns]


def true(*expressions: str, where: str | None = None) -> list[Check]:
    return [expression_is_true(expression, where) for expression in expressions]


def stage_checks(tables: dict[str, DataFrame], today: Column, main: Sequence[str]) -> dict[str, list[Check]]:
    big = F.col("main_competition_id").isin(*main)
    return {
        "stg_areas": [
            *key("country_id", "area_id", "country_name", "country_code"),
            length_equals("country_code", 3, where="country_name != 'United Kingdom'"),
            not_null("continent_name", where="continent_id IS NOT NULL"),
            accepted_values("continent_name", v.CONTINENTS),
            not_null("parent_area_id", where="country_name != 'World'"),
        ],
        "stg_coaches": [
            *key("coach_id", "full_name"),
            *known("first_name", "last_name", "birth_date", "nationality"),
            expression_is_true(F.col("birth_date") > today - F.expr("INTERVAL 80 YEARS")),
        ],
        "stg_competitions": [
            *key("competition_id", "competition_name", "competition_code"),
            accepted_values("competition_name", v.COMPETITION_NAMES),
            not_null("competition_type"),
            accepted_values("competition_type", ["league", "cup"]),
            not_null("current_season_id"),
            relationships("current_season_id", tables["stg_seasons"], "season_id", where="competition_id != '2000'"),
        ],
        "stg_matches": [
            *key("match_id"),
            *known("match_at", "status", "matchday_number", "stage", "duration_type", "last_updated_at"),
            accepted_values("status", v.MATCH_STATUSES),
            accepted_range("matchday_number", 1, v.MAX_MATCHES),
            accepted_values("stage", v.MATCH_STAGES),
            *names_of(tables, "stg_teams", "home_team_id", "away_team_id", field="team_id"),
            not_null("winner", where=DECIDED),
            accepted_values("winner", ["home", "away", "draw"]),
            accepted_values("duration_type", ["regular", "extra time", "penalty shootout"]),
            *names_of(tables, "stg_areas", "area_id"),
            *names_of(tables, "stg_competitions", "competition_id"),
            *names_of(tables, "stg_seasons", "season_id"),
            expression_is_true(F.col("last_updated_at") < today),
            *true("match_at > TIMESTAMP_NTZ'2020-01-01 00:00:00'", "matchday_number > 0", "home_team_id != away_team_id"),
            *true("match_at < last_updated_at", where=DECIDED),
            *true(DECIDED, where="CAST(match_at AS DATE) < last_updated_at - INTERVAL 24 HOURS"),
        ],
        "stg_players": [
            *key("player_id"),
            *known("name", "last_updated_at"),
            not_null("date_of_birth").warn(),
            *names_of(tables, "stg_areas", "nationality", field="country_name"),
            *known("section", "position", "current_team_id"),
            accepted_values("section", v.POSITIONS),
            accepted_values("position", v.POSITIONS),
            accepted_range("player_number", 0, 100),
            unique_combination(["name", "date_of_birth"]),
            # an unknown month passes either way
            *true("contract_start_month < contract_end_month"),
        ],
        "stg_referees": [
            *key("referee_id"),
            not_null("full_name"),
            *names_of(tables, "stg_areas", "nationality", field="country_name"),
        ],
        "stg_seasons": [
            *key("season_uid", "season_id"),
            *known("start_date", "end_date"),
            *names_of(tables, "stg_competitions", "competition_id"),
            greater_than("end_date", "start_date"),
        ],
        "stg_teams": [
            *key("team_id", "team_name"),
            # two clubs share this short name
            unique("team_short_name", where="team_short_name != 'Club Nacional'"),
            not_null("team_short_name", where=F.col("team_id").isin(*main)),
            not_null("team_code"),
            length_between("team_code", 2, 3, where=big),
            *names_of(tables, "stg_areas", "country_name"),
            not_null("foundation_year_date", where=F.col("team_id").isin(*main)),
            *names_of(tables, "stg_competitions", "main_competition_id", field="competition_id"),
            not_null("coach_id", where=big).warn(),
            *[
                not_null(f"coach_contract_{end}_date", where=F.col("coach_id").isNotNull() & big).warn()
                for end in ("start", "end")
            ],
            not_null("season_id"),
            min_list_length("running_competitions_ids", 0),
            min_list_length("player_ids", 11, or_equal=True),
            greater_than(
                "coach_contract_end_date", "coach_contract_start_date", or_equal=True, where="coach_id IS NOT NULL"
            ),
        ],
    }


def mart_checks(tables: dict[str, DataFrame], today: Column, main: Sequence[str]) -> dict[str, list[Check]]:
    team = names_of(tables, "stg_teams", "team_id", "team_name")
    competition = names_of(tables, "stg_competitions", "competition_id", "competition_name")
    match = names_of(tables, "stg_matches", "match_id")
    side = [
        not_null("team_playing_location"),
        accepted_values("team_playing_location", ["home", "away"]),
        equal_counts("team_playing_location", "home", "away"),
        accepted_values("team_result", ["win", "draw", "loss"]),
        not_null("team_result", where="match_status = 'finished'"),
        *known("match_status", "match_stage"),
        accepted_values("match_status", v.MATCH_STATUSES),
        accepted_values("match_stage", v.MATCH_STAGES),
        *true("match_status = 'finished'", where="team_result IS NOT NULL"),
    ]
    goals_decide = {"goals_scored > goals_conceded": (3, "win"), "goals_scored = goals_conceded": (1, "draw")}
    goals_decide["goals_scored < goals_conceded"] = (0, "loss")
    points = ("home_pts", "away_pts", "total_pts")
    outcomes = ("wins", "draws", "losses")
    goals = ("number_of_goals_scored", "number_of_goals_conceded")
    running_goals = [f"running_{name}" for name in goals]
    venue_goals = [f"{name}_{at}" for name in running_goals for at in ("at_home", "away")]
    per_version = {
        1: [f"version_number_of_{outcome}" for outcome in outcomes],
        3: [f"version_{name}" for name in points],
        20: [*[f"version_{name}" for name in goals], "version_total_number_of_goals_in_match"],
    }
    all_running = {
        v.MAX_MATCHES: [f"running_number_of_{outcome}" for outcome in outcomes],
        v.MAX_POINTS / 2: ["running_home_pts", "running_away_pts"],
        v.MAX_POINTS: ["running_total_pts"],
        v.MAX_MATCHES * 10: running_goals,
        v.MAX_MATCHES * 20: ["running_total_number_of_goals_in_matches"],
        v.MAX_SEASON_GOALS: venue_goals,
    }
    bounded = [
        check
        for limits in (per_version, all_running)
        for limit, columns in limits.items()
        for check in (*known(*columns), *between(0, limit, *columns))
    ]
    match_counts = [
        *[f"number_of_{venue}_matches" for venue in ("home", "away")],
        "total_number_of_matches",
        *[f"number_of_{venue}{outcome}" for venue in ("home_", "away_", "") for outcome in outcomes],
    ]
    table_sums = [
        *points,
        *[f"goals_{kind}_{at}" for kind in ("scored", "conceded") for at in ("at_home", "away")],
        *[f"total_goals_{kind}" for kind in ("scored", "conceded")],
    ]
    return {
        "int_matches_per_team": [
            *key("team_match_id"),
            *match,
            *names_of(tables, "stg_teams", "team_id"),
            *names_of(tables, "stg_competitions", "competition_id"),
            *side,
        ],
        "matches_per_team": [
            *key("team_match_id"),
            *match,
            *team,
            *competition,
            *side,
            *names_of(tables, "stg_teams", "opponent_team_id", field="team_id"),
            *names_of(tables, "stg_teams", "opponent_team_name", field="team_name"),
            *[accepted_values(name, [0, 1, 3]) for name in points],
            *known("goals_scored", "goals_conceded"),
            *between(0, 20, "goals_scored", "goals_conceded"),
            unique_combination(["match_id", "opponent_team_id", "match_at"]),
            *true(*[f"{name} IS NULL" for name in points], where=KNOCKOUT),
            *[
                check
                for goals, (pts, result) in goals_decide.items()
                for check in (
                    *true(f"home_pts = {pts}", where=f"{goals} AND team_playing_location = 'home'"),
                    *true(f"away_pts = {pts}", where=f"{goals} AND team_playing_location = 'away'"),
                    *true(f"total_pts = {pts}", where=goals),
                    *true(goals, where=f"team_result = '{result}'"),
                )
            ],
        ],
        "standings_current": [
            *key("current_placement_id"),
            not_null("ranking"),
            accepted_range("ranking", 1, 50),
            *team,
            *competition,
            *known(*table_sums, *match_counts),
            *between(0, 500, *[name for name in table_sums if name != "goals_scored_away"]),
            accepted_range("goals_scored_away", 0, 200),
            *between(0, v.MAX_MATCHES, *match_counts),
            unique_combination(["competition_id", "ranking"]),
            *[
                check
                for venue in ("home", "away")
                for check in (
                    *true(f"number_of_{venue}_matches > 0", where=f"number_of_{venue}_wins > 0"),
                    *true(f"number_of_{venue}_wins > 0", where=f"{venue}_pts > 0"),
                )
            ],
        ],
        "standings_versions": [
            *key("standings_version_id"),
            *match,
            not_null("version_start_at"),
            not_null_but_latest("version_end_at", ["team_id", "competition_id"], "version_start_at"),
            *team,
            *competition,
            accepted_values("competition_id", main),
            *names_of(tables, "seasons", "season_id", "season_name"),
            *bounded,
            *[
                check
                for pts, outcome in ((3, "wins"), (1, "draws"), (0, "losses"))
                for check in true(f"version_number_of_{outcome} = 1", where=f"version_total_pts = {pts}")
            ],
            *true("version_home_pts = 3", where="version_number_of_wins = 1 AND version_away_pts = 0"),
            *true("version_away_pts = 3", where="version_number_of_wins = 1 AND version_home_pts = 0"),
            *true("version_total_pts = 3", where="version_number_of_wins = 1"),
            greater_than("version_number_of_goals_scored", "version_number_of_goals_conceded", where="version_number_of_wins = 1"),
            greater_than("version_number_of_goals_conceded", "version_number_of_goals_scored", where="version_number_of_losses = 1"),
            unique_combination(["match_id", "team_id"]),
            greater_than("version_end_at", "version_start_at", or_equal=True),
            no_overlapping_periods(
                "version_start_at", "version_end_at", "standings_version_id", ["team_id", "competition_id"]
            ),
            *true("running_total_pts > 0", where="running_number_of_wins + running_number_of_draws > 0"),
            *true("running_home_pts + running_away_pts = running_total_pts"),
        ],
        "standings_weekly": [
            accepted_range("ranking", 1, v.MAX_TEAMS, where="competition_id NOT IN ('2001', '2152')"),
            unique_combination(["week_start_date", "team_id", "competition_id"]),
        ],
        "streaks": [
            *key("streak_id"),
            *team,
            *competition,
            list_relationships("streak_match_ids", tables["stg_matches"], "match_id"),
            min_list_length("streak_match_ids", 0),
            min_list_length("streak_match_ats", 0),
            not_null("streak_number_of_matches"),
            accepted_range("streak_number_of_matches", 1, 20),
            not_null("streak_type"),
            accepted_values("streak_type", ["win", "draw", "loss"]),
            *names_of(tables, "stg_matches", "streak_start_match_id", "streak_end_match_id", field="match_id"),
            not_null("streak_start_at"),
            *true(
                "array_size(streak_match_ids) < 20",
                "array_size(streak_match_ids) = streak_number_of_matches",
                "array_contains(streak_match_ids, streak_start_match_id)",
                "array_contains(streak_match_ids, streak_end_match_id)",
            ),
            greater_than("streak_end_at", "streak_start_at", or_equal=True),
            expression_is_true(F.col("streak_start_at") < today),
            expression_is_true(F.col("streak_end_at") < today),
            no_element_after("streak_match_ats", today, "streak_match_at"),
        ],
        "players": [
            *key("player_id"),
            *known("name", "date_of_birth", "age", "nationality", "section", "position"),
            *true("date_of_birth > DATE'1965-01-01'"),
            accepted_range("age", 16, 50),
            accepted_values("section", v.POSITIONS),
            accepted_values("position", v.POSITIONS),
            accepted_range("player_number", 1, 99),
            *team,
            *competition,
            *known("contract_start_month", "contract_end_month"),
            *true("contract_start_month < contract_end_month"),
        ],
        "seasons": [
            *key("season_id", "season_name"),
            relationships("season_id", tables["stg_seasons"], "season_id"),
            *names_of(tables, "stg_seasons", "start_date", "end_date"),
            *competition,
            *true("start_date < end_date"),
        ],
        "playoff_matches": [
            *key("match_id"),
            *known("match_at", "status", "matchday_number", "match_stage", "duration_type", "last_updated_at"),
            expression_is_true(F.col("match_at") < today, where="status = 'finished'"),
            accepted_values("status", v.MATCH_STATUSES),
            accepted_range("matchday_number", 0, 2),
            accepted_values("match_stage", v.KNOCKOUT_STAGES),
            *[
                check
                for venue in ("home", "away")
                for name in ("id", "name")
                for check in names_of(tables, "stg_teams", f"{venue}_team_{name}", field=f"team_{name}")
            ],
            not_null("winner", where=DECIDED),
            accepted_values("winner", ["home", "away", "draw"]),
            accepted_values("duration_type", ["regular", "extra time", "penalty shootout"]),
            *names_of(tables, "stg_areas", "area_id"),
            not_null("competition_id"),
            accepted_values("competition_id", [v.CHAMPIONS_LEAGUE]),
            not_null("competition_name"),
            *true("competition_name = 'UEFA Champions League'"),
            *names_of(tables, "stg_seasons", "season_id"),
            expression_is_true(F.col("last_updated_at") < today),
        ],
        "countries": [
            *key("country_id", "area_id", "country_name", "country_code"),
            length_equals("country_code", 3, where="country_name != 'United Kingdom'"),
            *[
                relationships(name, tables["stg_areas"], name)
                for name in ("country_id", "area_id", "country_name", "country_code")
            ],
            *names_of(tables, "countries", "continent_id"),
        ],
        "continents": [
            *key("continent_id", "continent_name"),
            *[relationships(name, tables["stg_areas"], name) for name in ("continent_id", "continent_name")],
        ],
        "calendar": [
            accepted_range("date_month", 1, 12),
            accepted_range("date_week", 1, 53),
            *known("week_start_date", "week_end_date"),
            accepted_values("month_name", list(v.MONTHS)),
            accepted_values("month_short_name", list(v.MONTHS.values())),
            accepted_range("date_year", 2000, 2050),
            *true(
                "date_day >= TIMESTAMP_NTZ'2000-01-01 00:00:00' AND date_day <= TIMESTAMP_NTZ'2050-12-31 00:00:00'",
                "week_end_date = week_start_date + INTERVAL 6 DAY",
                "weekofyear(week_start_date) = date_week AND weekofyear(week_end_date) = date_week",
            ),
            unique_combination(["week_start_date", "date_day"]),
            unique_combination(["week_end_date", "date_day"]),
        ],
    }


def extra_checks(today: Column) -> dict[str, list[Check]]:
    """Two kinds of check that are defined but not declared for any table, where they make sense."""
    closes = scan_is_true(
        "version_end_at = next_start",
        ["team_id", "competition_id", "season_id"],
        ["version_start_at", "match_id"],
        {"next_start": following("version_start_at")},
        where="version_start_at IS NOT NULL",
    )
    return {
        "standings_versions": [closes],
        "players": [minimum_after("date_of_birth", today - F.expr("INTERVAL 50 YEARS"))],
    }


def declared(
    tables: dict[str, DataFrame], as_of: dt.date, main: Sequence[str] = tuple(v.MAIN_COMPETITION_IDS)
) -> dict[str, list[Check]]:
    """All checks by table; ``main`` are the ids of the main competitions."""
    today = F.lit(as_of)
    return {**stage_checks(tables, today, main), **mart_checks(tables, today, main)}


def run_declared(tables: dict[str, DataFrame], as_of: dt.date, **options) -> DataFrame:
    """Failures of every declared check: table, check, severity, failures."""
    results = None
    for name, checks in declared(tables, as_of, **options).items():
        if name in tables:
            found = run_checks(tables[name], checks).select(F.lit(name).alias("table"), "*")
            results = found if results is None else results.unionByName(found)
    return results
