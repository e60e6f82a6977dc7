"""Small frames for single operators: ties, unknown values, empty input."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from touchline.operators import dims, sides, standings, streaks, versions
from touchline.operators.batches import nested_ids
from touchline.operators.calendar import calendar, periods
from touchline.operators.dedup import any_row, latest_row
from touchline.operators.grid import DayGrid, grid_left_join, number_of_points, points_within, weeks
from touchline.operators.ordered import row_number, running_sum
from touchline.operators.overrides import apply_overrides, corrected
from touchline.sources import landing

T0 = dt.datetime(2024, 1, 1)
SEGMENTED = {"max_group_rows": 5, "segment_rows": 10}


def hours(n):
    return T0 + dt.timedelta(hours=n)


# --- dedup and corrections -------------------------------------------------------------------


def test_latest_row(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, None, "b"), (1, 5, "c"), (2, None, "d"), (None, 1, "e")], "k int, t int, v string")
    assert rows(latest_row(df, ["k"], "t", ties=["v"])) == [(1, 5, "a"), (2, None, "d"), (None, 1, "e")]


def test_latest_row_is_pruned_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = latest_row(df, ["k"], "id")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("WindowGroupLimit") < plan.index("Exchange")


def test_any_row_is_the_same_each_time(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    once = rows(any_row(df, ["k"]))
    assert once == rows(any_row(df.repartition(13), ["k"])) and len(once) == 7


def test_corrections(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (4, None)], "k int, v string")
    assert rows(df.select("k", corrected("v", "k", {1: "A", 4: "D"}))) == [(1, "A"), (2, "b"), (4, "D"), (None, "c")]
    table = spark.createDataFrame([(2, "B"), (4, None)], "key int, value string")
    assert rows(apply_overrides(df, "k", "v", table, "key", "value")) == [(1, "a"), (2, "B"), (4, None), (None, "c")]


def test_nested_ids(spark):
    df = spark.createDataFrame([([(3,), (1,)],), ([(1,), (None,)],), ([],), (None,)], "squad array<struct<id:int>>")
    assert rows(nested_ids(df, "squad")) == [(1,), (3,), (None,)]


def test_pages_of_different_columns(spark):
    pages = [spark.createDataFrame([(1, "x")], "a int, b string"), spark.createDataFrame([(2.5, 2)], "c double, a int")]
    assert rows(landing.concat_pages(pages)) == [(1, "x", None), (2, None, 2.5)]


# --- calendar and grid -----------------------------------------------------------------------


def test_calendar(spark):
    found = calendar(spark)
    assert found.count() == 18263
    first, last = found.orderBy("date_day").first(), found.orderBy(F.col("date_day").desc()).first()
    assert tuple(first) == (dt.datetime(2000, 1, 1), 52, dt.datetime(1999, 12, 27), dt.datetime(2000, 1, 2), 1, "January", "Jan", 2000)
    assert last.date_day == dt.datetime(2049, 12, 31) and last.month_name == "December"


def test_periods(spark):
    found = periods(spark, dt.date(2024, 8, 1), dt.date(2024, 8, 21))
    assert rows(found.drop("period_number")) == [
        (dt.date(2024, 8, 1), dt.date(2024, 8, 11)),
        (dt.date(2024, 8, 11), dt.date(2024, 8, 21)),
        (dt.date(2024, 8, 21), dt.date(2024, 8, 31)),
    ]
    assert periods(spark, dt.date(2024, 8, 2), dt.date(2024, 8, 1)).count() == 0


def test_week_grids():
    mondays, sundays = weeks(dt.date(2000, 1, 1), dt.date(2050, 1, 1)), weeks(dt.date(2000, 1, 1), dt.date(2050, 1, 1), day=6)
    assert (mondays.first, mondays.last, mondays.size) == (dt.date(1999, 12, 27), dt.date(2049, 12, 27), 2610)
    assert (sundays.first, sundays.last) == (dt.date(2000, 1, 2), dt.date(2050, 1, 2))


@pytest.mark.parametrize("closed", [False, True])
@pytest.mark.parametrize("step", [1, 7])
def test_points_within_equal_brute_force(spark, closed, step):
    rnd = random.Random(step)
    grid = DayGrid(dt.date(2024, 1, 8), dt.date(2024, 3, 4), step)
    points = [dt.datetime.combine(grid.first + dt.timedelta(days=i * step), dt.time()) for i in range(grid.size)]
    moment = lambda: T0 + dt.timedelta(hours=rnd.choice([24, 1]) * rnd.randrange(80 if rnd.random() < 0.5 else 1800))
    data = [(i, rnd.choice([moment(), moment(), None]), rnd.choice([moment(), moment(), None])) for i in range(300)]
    data += [(900, points[0], points[1]), (901, points[0], points[0]), (902, points[-1], points[-1] + dt.timedelta(days=99))]
    df = spark.createDataFrame(data, "id int, s timestamp_ntz, e timestamp_ntz")
    inside = lambda p, s, e: s and e and s <= p and (p <= e if closed else p < e)
    expected = sorted((i, p) for i, s, e in data for p in points if inside(p, s, e))
    found = sorted((r.id, r.p) for r in points_within(df, grid, "p", "s", "e", closed).collect())
    assert found == expected
    counts = df.select("id", number_of_points(grid, "s", "e", closed).alias("n")).collect()
    assert {r.id: r.n for r in counts} == {i: sum(1 for j, _ in expected if j == i) for i, _, _ in data}
    left = grid_left_join(df, grid, "p", "s", "e", closed)
    taken = {p for _, p in expected}
    assert sorted(r.p for r in left.filter("id IS NULL").collect()) == [p for p in points if p not in taken]
    assert left.filter("id IS NOT NULL").count() == len(expected)


def test_no_nested_loop_in_the_grid_join(spark):
    df = spark.createDataFrame([(1, T0, T0)], "id int, s timestamp_ntz, e timestamp_ntz")
    plan = grid_left_join(df, weeks(dt.date(2024, 1, 1), dt.date(2024, 2, 1)), "p", "s", "e")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


# --- sides and tables ------------------------------------------------------------------------

MATCH = (
    "match_id string, match_at timestamp_ntz, status string, stage string, home_team_id string, away_team_id string, "
    "competition_id string, season_id string, winner string, full_time_home_score int, full_time_away_score int"
)


def matches(spark, *games):
    data = []
    for i, (home, away, h, a, *rest) in enumerate(games):
        status = rest[0] if rest else "finished"
        winner = None if h is None else "home" if h > a else "away" if h < a else "draw"
        data.append((f"m{i:03}", hours(24 * i), status, "regular season", home, away, "1", "s", winner, h, a))
    return spark.createDataFrame(data, MATCH)


def dimension(spark, kind, *ids):
    extra = ", logo_url string, team_short_name string, main_competition_id string" if kind == "team" else ""
    data = [(i, f"{kind} {i}", "l", i, "1")[: 5 if kind == "team" else 2] for i in ids]
    return spark.createDataFrame(data, f"{kind}_id string, {kind}_name string{extra}")


def test_sides_of_odd_matches(spark):
    df = matches(spark, ("a", "b", 1, 0), ("a", "a", 1, 1), (None, "b", 0, 2), ("c", "a", None, None, "timed"))
    found = sides.per_side(df)
    assert found.count() == 8
    result = {(r.match_id, r.team_playing_location): r.team_result for r in found.collect()}
    assert result["m000", "home"] == "win" and result["m000", "away"] == "loss" and result["m003", "home"] is None
    facts = sides.match_facts(df, dimension(spark, "team", "a", "b"), dimension(spark, "competition", "1"))
    opponent = {(r.match_id, r.team_playing_location): (r.opponent_team_id, r.opponent_team_name) for r in facts.collect()}
    assert opponent["m000", "home"] == ("b", "team b")
    assert opponent["m001", "home"] == (None, None) and opponent["m002", "away"] == (None, None)
    assert opponent["m003", "away"] == ("c", None)
    other = sides.other_side(sides.union_sides(df, ["team_id"], "venue", ["match_id"]))
    assert {(r.match_id, r.venue): r.opponent_team_id for r in other.collect()} == {k: o for k, (o, _) in opponent.items()}


def test_duplicate_matches_are_dropped_on_request(spark):
    df = matches(spark, ("a", "b", 1, 0))
    twice = df.unionByName(df)
    assert sides.per_side(twice).count() == 4 and sides.per_side(twice, distinct=True).count() == 2


@pytest.mark.parametrize("limits", [{}, {"max_group_rows": 2, "segment_rows": 2}])
def test_tables(spark, limits):
    games = [("a", "b", 2, 0), ("b", "a", 1, 1), ("a", "c", 0, 3), ("b", "c", 1, 0), ("d", "a", None, None, "timed")]
    df = matches(spark, *games)
    table = {r.team_id: r for r in standings.standings(df, **limits).collect()}
    # c plays away only and is missing; d has no match that counts
    assert {t: (r.ranking, r.total_pts, r.home_pts, r.away_pts) for t, r in table.items()} == {
        "a": (1, 4, 3, 1),
        "b": (2, 4, 4, 0),
    }
    full = {r.team_id: (r.ranking, r.total_pts, r.total_goals_scored, r.total_number_of_matches) for r in standings.full_standings(df, **limits).collect()}
    assert {t: values[1:] for t, values in full.items()} == {"a": (4, 3, 3), "b": (4, 2, 3), "c": (3, 3, 2)}
    # a: 3-4, b: 2-3, both -1: goals scored decide
    assert [t for t, _ in sorted(full.items(), key=lambda item: item[1])] == ["a", "b", "c"]


def test_ties_fall_to_the_team(spark):
    df = matches(spark, ("z", "y", 1, 1), ("y", "z", 1, 1), ("x", "w", 1, 1), ("w", "x", 1, 1))
    assert [r.team_id for r in standings.standings(df).orderBy("ranking").collect()] == ["w", "x", "y", "z"]


def test_unknown_totals_come_last(spark):
    df = matches(spark, ("only home", "a", 5, 0), ("a", "b", 0, 1), ("b", "a", 0, 1))
    found = [(r.ranking, r.team_id, r.total_pts) for r in standings.standings(df).orderBy("ranking").collect()]
    assert found == [(1, "b", 3), (2, "a", 3), (3, "only home", None)]


def test_points_by_venue(spark):
    df = matches(spark, ("a", "b", 1, 0), ("a", "b", None, None, "timed"), ("c", "a", 0, 0))
    found = standings.points_by_venue(df, dimension(spark, "team", "a", "b", "x"), "1").collect()
    assert [(r.team_id, r.home_pts, r.away_pts, r.total_pts) for r in found] == [("a", 4, 1, 5), ("b", None, 1, None), ("x", None, None, None)]


# --- versions --------------------------------------------------------------------------------


@pytest.mark.parametrize("limits", [{}, SEGMENTED])
def test_versions_close_one_another(spark, limits):
    data = [("u", hours(i // 2), i, i) for i in range(40)] + [("v", hours(1), 100, 7)]
    df = spark.createDataFrame(data, "k string, at timestamp_ntz, id int, x int")
    found = versions.versions(df, ["k"], "at", {"n": row_number(), "sum": running_sum("x")}, ["id"], "s", "e", **limits)
    got = {r.id: (r.s, r.e, r.n, r["sum"]) for r in found.collect()}
    for i in range(40):
        assert got[i] == (hours(i // 2), hours((i + 1) // 2) if i < 39 else None, i + 1, i * (i + 1) // 2)
    assert got[100] == (hours(1), None, 1, 7)


def test_history_of_unscored_matches(spark):
    df = matches(spark, ("a", "b", None, None, "awarded"), ("a", "b", 2, 0))
    history = versions.standings_versions(
        df, dimension(spark, "team", "a"), dimension(spark, "competition", "1"),
        spark.createDataFrame([("s", "S")], "season_id string, season_name string"),
    )
    mine = history.filter("team_id = 'a'").orderBy("version_start_at").collect()
    assert [(r.version_number_of_wins, r.version_total_pts, r.running_total_pts, r.running_home_pts) for r in mine] == [
        (0, None, None, None),
        (1, 3, 3, 3),
    ]
    assert history.filter("team_id = 'b'").first().team_name is None


@pytest.mark.parametrize("limits", [{}, {"max_group_rows": 1, "segment_rows": 5}])
def test_weekly_ranking(spark, limits):
    df = matches(spark, *[("a", "b", i % 3, 1) for i in range(20)], *[("c", "a", 1, 1)] * 5)
    history = versions.standings_versions(
        df, dimension(spark, "team", "a"), dimension(spark, "competition", "1"),
        spark.createDataFrame([("s", "S")], "season_id string, season_name string"),
    )
    grid = weeks(dt.date(2024, 1, 1), dt.date(2024, 3, 1))
    found = versions.weekly_standings(history, grid, **limits).collect()
    by_week = {}
    for row in found:
        by_week.setdefault(row.week_start_date, []).append((row.ranking, row.team_id))
    assert len(by_week) == grid.size
    assert by_week[dt.datetime(2024, 1, 1)] == [(1, None)]
    # after seven matches: a won two and lost three
    assert sorted(by_week[dt.datetime(2024, 1, 8)]) == [(1, "b"), (2, "a")]
    # the last version stays for one week
    assert by_week[dt.datetime(2024, 2, 26)] == [(1, None)]


# --- streaks ---------------------------------------------------------------------------------

RESULTS = "k string, at timestamp_ntz, id string, r string"


@pytest.mark.parametrize("limits", [{}, {"max_group_rows": 3, "segment_rows": 4}])
def test_streaks(spark, limits):
    results = ["win", "win", None, None, "loss", "draw", "draw", "draw"]
    data = [("u", hours(i), f"{20 - i}", r) for i, r in enumerate(results)]
    df = spark.createDataFrame(data, RESULTS)
    found = streaks.streaks(df, ["k"], "at", "r", "id", lists=True, **limits).orderBy("streak_number").collect()
    assert [(s.streak_number, s.streak_type, s.members) for s in found] == [
        (1, "win", ["20", "19"]),
        (2, None, ["18"]),
        (3, None, ["17"]),
        (4, "loss", ["16"]),
        (5, "draw", ["15", "14", "13"]),
    ]
    assert (found[0].first_member, found[0].last_member) == ("19", "20")
    assert found[0].end_at == hours(1) + dt.timedelta(hours=2) and found[4].end_at is None
    by_time = streaks.streaks(df, ["k"], "at", "r", "id", endpoints="time", **limits).orderBy("streak_number").first()
    assert (by_time.first_member, by_time.last_member) == ("20", "19")
    plain = streaks.streaks(df, ["k"], "at", "r", "id", **limits)
    assert "members" not in plain.columns
    assert [r.number_of_members for r in plain.orderBy("streak_number").collect()] == [2, 1, 1, 1, 3]


def test_two_matches_at_one_time(spark):
    df = spark.createDataFrame([("u", T0, "1", "win"), ("u", T0, "2", "loss"), ("u", hours(1), "3", "loss")], RESULTS)
    found = streaks.streaks(df, ["k"], "at", "r", "id", lists=True).orderBy("streak_number").collect()
    assert [s.members for s in found] == [["1"], ["2", "3"]]


def test_long_streaks_keep_their_numbers_and_members(spark):
    data = [("u", hours(i), f"{i:03}", "win") for i in range(30)] + [("u", hours(99), "x", "loss")]
    df = spark.createDataFrame(data, RESULTS)
    long, short = streaks.streaks(df, ["k"], "at", "r", "id", lists=True).orderBy("streak_number").collect()
    assert (long.members, long.number_of_members, long.last_member) == ([f"{i:03}" for i in range(30)], 30, "029")
    assert long.member_times == [hours(i) for i in range(30)] and short.members == ["x"]
    members = streaks.streak_members(df, ["k"], "at", "r", "id").filter("streak_number = 1")
    assert [r.id for r in members.orderBy("position").collect()] == [f"{i:03}" for i in range(30)]


# --- dimensions ------------------------------------------------------------------------------


def test_season_names(spark):
    df = spark.createDataFrame([("1", dt.date(2024, 8, 1), dt.date(2025, 5, 1)), (None, dt.date(2024, 1, 1), None)], "id string, s date, e date")
    name = dims.season_name(F.lit("Liga"), "s", "e", F.col("id") == "2013")
    assert rows(df.select("id", name)) == [("1", "Liga 2024 - 2025"), (None, None)]


def test_orphans(spark):
    facts = spark.createDataFrame([("1", 1), ("2", 2), (None, 3), ("2", 4)], "key string, n int")
    dimension_ = spark.createDataFrame([(1,), (1,), (None,)], "id long")
    assert rows(dims.orphans(facts, dimension_, "key", "id")) == [("2", 2), ("2", 4)]
