"""From landed JSON files to the marts."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

import football
from helpers import rows
from touchline.operators import quality as q
from touchline.operators.quality import run_checks
from touchline.operators.contract import ContractBroken, contract_breaks, contract_report, enforce_contract
from touchline.plans import checks, warehouse
from touchline.plans.publishing import publish
from touchline.sources import landing, schemas
from touchline.sources.tables import create_or_replace, source

AS_OF = dt.date(2025, 5, 2)


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folder = football.write(tmp_path_factory.mktemp("landed"))
    read = lambda name: landing.read_payloads(spark, f"{folder}/{name}.json")
    kept = ["id", "name", "countryCode", "flag", "parentAreaId", "parentArea"]
    return {
        "areas": landing.land(read("areas"), "areas", schemas.AREA, kept),
        "competitions": landing.land(read("competitions"), "competitions", schemas.COMPETITION),
        "matches": landing.matches_table(read("matches"), schemas.MATCH),
        "teams": landing.teams_table(read("teams"), schemas.TEAM, schemas.TEAM_PARENTS),
        "players": landing.players_table(read("persons"), schemas.PERSON),
    }


@pytest.fixture(scope="module")
def tables(raw):
    return {name: df.cache() for name, df in warehouse.build(raw, AS_OF).items()}


def pick(df, *columns):
    return rows(df.select(*columns))


def test_every_table_is_there(tables):
    assert len(tables) == 20
    assert all(df.count() > 0 for df in tables.values())


def test_only_what_is_wanted_is_built(raw):
    assert set(warehouse.build(raw, AS_OF, wanted=["stg_players"])) == {"stg_players"}
    assert set(warehouse.build(raw, AS_OF, wanted=["seasons"])) == {"stg_competitions", "stg_seasons", "seasons"}


def test_areas_are_corrected(tables):
    names = {row.area_id: (row.country_name, row.continent_name) for row in tables["stg_areas"].collect()}
    assert names["2030"] == ("Bosnia-Herzegovina", "Europe")
    assert names["2192"] == ("Ireland", "Europe")
    assert names["2145"] == ("Mexico", "North America")
    assert names["2267"] == ("World", None)
    assert pick(tables["continents"], "continent_name") == [("Europe",), ("North America",), ("South America",)]
    assert tables["countries"].filter("country_name = 'World'").count() == 0


def test_matches_are_current(tables):
    matches = {row.match_id: row for row in tables["stg_matches"].collect()}
    assert sorted(matches) == ["10", "100", "101", "11", "12", "13", "200", "201", "202", "301", "9"]
    assert (matches["12"].status, matches["12"].full_time_home_score) == ("finished", 4)
    assert matches["100"].status == "in play" and matches["100"].winner is None
    assert matches["9"].match_at == dt.datetime(2024, 8, 17, 14)
    assert matches["9"].referees_ids == ["80747", "11"]
    # empty and missing lists alike
    assert matches["10"].referees_ids is None and matches["11"].referees_ids is None


def test_teams(tables):
    teams = {row.team_id: row for row in tables["stg_teams"].collect()}
    assert sorted(teams) == ["1765", "356", "57", "61", "65", "86"]
    assert teams["61"].main_competition_id == "2001"
    assert teams["356"].foundation_year_date == dt.date(1889, 1, 1)
    assert teams["57"].foundation_year_date == dt.date(1900, 1, 1)
    assert teams["57"].team_colors == ["Red", "White"] and teams["65"].team_colors is None
    assert teams["57"].player_ids == [str(i) for i in range(100, 112)] and teams["356"].player_ids is None
    assert teams["57"].coach_contract_end_date == dt.date(2026, 6, 1)
    assert teams["61"].coach_contract_start_date is None


def test_coach_of_two_teams_appears_twice(tables):
    assert [row.coach_id for row in tables["stg_coaches"].collect()].count("1") == 2


def test_seasons(tables):
    assert pick(tables["stg_seasons"], "season_uid", "season_id") == [
        ("campeonato_brasileiro_serie_a_2025_2025", "2302"),
        ("premier_league_2024_2025", "2300"),
        ("uefa_champions_league_2024_2025", "2301"),
    ]
    assert pick(tables["seasons"], "season_name") == [
        ("Campeonato Brasileiro Série A 2025",),
        ("Premier League 2024 - 2025",),
        ("UEFA Champions League 2024 - 2025",),
    ]


def test_players(tables):
    players = {row.player_id: row for row in tables["players"].collect()}
    assert len(players) == 5
    assert players["100"].age == 25 and players["101"].age == 26
    assert players["191106"].date_of_birth == dt.date(2005, 1, 4) and players["191106"].team_name == "Chelsea FC"
    assert players["192652"].nationality == "Brazil" and players["192652"].contract_end_month is None
    assert players["191811"].date_of_birth == dt.date(1995, 1, 1)
    assert players["191811"].team_name is None and players["191811"].competition_id is None
    assert players["101"].nationality == "United States"


def test_standings(tables):
    league = tables["standings_current"].filter("competition_id = '2021'").orderBy("ranking")
    found = [
        (r.ranking, r.team_id, r.home_pts, r.away_pts, r.total_pts, r.total_goals_scored, r.number_of_wins)
        for r in league.collect()
    ]
    # the team that only plays away is missing
    assert found == [(1, "57", 9, 4, 13, 9, 4), (2, "61", 3, 0, 3, 3, 1), (3, "65", 1, 0, 1, 3, 0)]
    europe = tables["standings_current"].filter("competition_id = '2001'").collect()
    # one league-stage match: no away match, so no total
    assert [(r.team_id, r.home_pts, r.away_pts, r.total_pts) for r in europe] == [("86", 3, None, None)]


def test_versions_follow_one_another(tables):
    history = tables["standings_versions"].filter("competition_id = '2021' AND team_id = '57'").orderBy("version_start_at")
    found = [
        (r.match_id, r.version_start_at, r.version_end_at, r.running_total_pts, r.running_number_of_goals_conceded)
        for r in history.collect()
    ]
    at = lambda *t: dt.datetime(2024, *t)
    assert found == [
        ("9", at(8, 17, 16), at(8, 18, 16), 3, 0),
        ("10", at(8, 18, 16), at(9, 1, 16), 4, 1),
        ("12", at(9, 1, 16), at(9, 14, 16), 7, 3),
        ("13", at(9, 14, 16), at(9, 22, 16), 10, 3),
        ("101", at(9, 22, 16), None, 13, 3),
    ]


def test_weekly_table(tables):
    weekly = tables["standings_weekly"]
    league = weekly.filter("competition_id = '2021' AND week_start_date = TIMESTAMP_NTZ'2024-08-26'").orderBy("ranking")
    # the match of that midnight ends two hours later, so it does not count yet
    assert [(r.ranking, r.team_id, r.running_total_pts) for r in league.collect()] == [
        (1, "57", 4),
        (2, "65", 1),
        (3, "61", 0),
    ]
    # weeks without any table stay, ranked 1, unknown otherwise
    empty = weekly.filter("week_start_date = TIMESTAMP_NTZ'2010-01-04'").collect()
    assert [(r.ranking, r.team_id) for r in empty] == [(1, None)]
    weeks = weekly.select("week_start_date").distinct()
    assert weeks.count() == tables["calendar"].select("week_start_date").distinct().count() == 2610


def test_match_facts(tables):
    facts = {(r.match_id, r.team_id): r for r in tables["matches_per_team"].collect()}
    assert len(facts) == 22
    row = facts["10", "57"]
    assert (row.team_result, row.home_pts, row.away_pts, row.total_pts) == ("draw", 0, 1, 1)
    assert (row.goals_scored, row.goals_conceded, row.opponent_team_name) == (1, 1, "Manchester City FC")
    assert row.match_month == dt.datetime(2024, 8, 1)
    knockout = facts["201", "61"]
    assert (knockout.home_pts, knockout.away_pts, knockout.total_pts) == (None, None, None)
    # an awarded match gives no points here
    awarded = facts["13", "57"]
    assert (awarded.away_pts, awarded.total_pts) == (0, None)


def test_streaks(tables):
    streaks = tables["streaks"].filter("team_id = '57'").orderBy("streak_start_at").collect()
    assert [(s.streak_type, s.streak_match_ids, s.streak_number_of_matches) for s in streaks] == [
        ("win", ["9"], 1),
        ("draw", ["10"], 1),
        ("win", ["12", "101"], 2),
    ]
    assert streaks[0].streak_end_at == dt.datetime(2024, 8, 17, 16)
    assert streaks[2].streak_end_at is None
    # the smallest and largest id as text, whatever was played first
    assert (streaks[2].streak_start_match_id, streaks[2].streak_end_match_id) == ("101", "12")


def test_playoffs(tables):
    found = [(r.match_id, r.match_stage, r.stage_order, r.home_team_name, r.away_team_name) for r in tables["playoff_matches"].collect()]
    assert found == [
        ("202", "final", 10, "Real Madrid CF", "Chelsea FC"),
        ("201", "playoffs", 50, "Chelsea FC", "Real Madrid CF"),
    ]


def test_declared_checks(tables):
    found = checks.run_declared(tables, AS_OF).collect()
    failed = {}
    for row in found:
        if row.failures and row.severity == "error":
            failed.setdefault(row.table, {})[row.check] = row.failures
    assert len(found) > 400
    assert failed == EXPECTED_FAILURES


def test_declared_checks_equal_each_on_its_own(tables):
    """Foreign keys, uniques and all others of the tables with the most kinds of checks, counted without their neighbours."""
    declared = checks.declared(tables, AS_OF)
    for name in ("stg_matches", "stg_teams", "streaks"):
        found = {(r.check, r.failures) for r in run_checks(tables[name], declared[name]).collect()}
        shared = [c for c in declared[name] if c.shared is not None]
        assert shared and {(c.name, c.count(tables[name]).first().failures) for c in shared} <= found


EXPECTED_FAILURES = {
    # a result of an awarded match; a club that is not in the team table
    'int_matches_per_team': {
        "is_true(match_status = 'finished') where team_result IS NOT NULL": 2,
        'relationships(team_id -> team_id)': 1,
    },
    # the same, and matches without a score
    'matches_per_team': {
        "is_true(away_pts = 3) where goals_scored > goals_conceded AND team_playing_location = 'away'": 1,
        "is_true(match_status = 'finished') where team_result IS NOT NULL": 2,
        'not_null(goals_conceded)': 4,
        'not_null(goals_scored)': 4,
        'not_null(opponent_team_name)': 1,
        'not_null(team_name)': 1,
        'relationships(opponent_team_id -> team_id)': 1,
        'relationships(team_id -> team_id)': 1,
    },
    # a player of an unknown team; one without contract
    'players': {
        'not_null(competition_id)': 1,
        'not_null(competition_name)': 1,
        'not_null(contract_end_month)': 1,
        'not_null(contract_start_month)': 1,
        'not_null(team_name)': 1,
        'relationships(team_id -> team_id)': 1,
    },
    # two teams without away matches; points from a draw only
    'standings_current': {
        'is_true(number_of_home_wins > 0) where home_pts > 0': 1,
        'not_null(away_pts)': 2,
        'not_null(goals_conceded_away)': 2,
        'not_null(goals_scored_away)': 2,
        'not_null(number_of_away_draws)': 2,
        'not_null(number_of_away_losses)': 2,
        'not_null(number_of_away_matches)': 2,
        'not_null(number_of_away_wins)': 2,
        'not_null(number_of_draws)': 2,
        'not_null(number_of_losses)': 2,
        'not_null(number_of_wins)': 2,
        'not_null(total_goals_conceded)': 2,
        'not_null(total_goals_scored)': 2,
        'not_null(total_number_of_matches)': 2,
        'not_null(total_pts)': 2,
    },
    # the unknown club
    'standings_versions': {
        'not_null(team_name)': 1,
        'relationships(team_id -> team_id)': 1,
    },
    # one coach of two teams
    'stg_coaches': {
        'unique(coach_id)': 1,
        'unique(full_name)': 1,
    },
    # updated before it was played; still in play; the unknown club
    'stg_matches': {
        "is_true(match_at < last_updated_at) where status IN ('finished', 'awarded')": 1,
        "is_true(status IN ('finished', 'awarded')) where CAST(match_at AS DATE) < last_updated_at - INTERVAL 24 HOURS": 1,
        'relationships(away_team_id -> team_id)': 1,
    },
    # countries that are not in the area table
    'stg_players': {
        'relationships(nationality -> country_name)': 2,
    },
    # France is not in the area table
    'stg_referees': {
        'relationships(nationality -> country_name)': 1,
    },
    # two small squads
    'stg_teams': {
        'list_length(player_ids)': 2,
    },
    # the unknown club
    'streaks': {
        'not_null(team_name)': 1,
        'relationships(team_id -> team_id)': 1,
    },
}


def test_contract(spark, tables):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert enforce_contract(df, {"b": "string", "a": "int"}).columns == ["b", "a"]
    assert contract_breaks(df, {"a": "bigint", "c": "string"}) == [
        ("a", "bigint", "int"),
        ("c", "string", None),
        ("b", None, "string"),
    ]
    assert contract_report(df, {"a": "int", "b": "string"}).count() == 0
    with pytest.raises(ContractBroken, match="a: declared bigint, found int"):
        enforce_contract(df, {"a": "bigint", "b": "string"})


def test_tables_are_written_and_replaced(spark, raw):
    spark.sql("CREATE DATABASE IF NOT EXISTS warehouse_test")
    try:
        write = lambda name, df: create_or_replace(df, f"warehouse_test.{name}")
        built = warehouse.build(raw, AS_OF, write)
        assert source(spark, "warehouse_test", "streaks").count() == built["streaks"].count()
        replaced = create_or_replace(spark.range(3), "warehouse_test.streaks")
        assert rows(replaced) == [(0,), (1,), (2,)]
        # out of the table itself
        again = create_or_replace(replaced.filter("id > 0"), "warehouse_test.streaks")
        assert rows(again) == [(1,), (2,)]
        # a failing job changes nothing
        with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
            create_or_replace(again.select(F.expr("1 / (id - 1)")), "warehouse_test.streaks")
        assert rows(source(spark, "warehouse_test", "streaks")) == [(1,), (2,)]
        # a reader that began before the replacement still has its rows
        reader = source(spark, "warehouse_test", "streaks")
        create_or_replace(spark.range(9), "warehouse_test.streaks")
        assert rows(reader) == [(1,), (2,)] and source(spark, "warehouse_test", "streaks").count() == 9
        # one version before the current one is kept
        assert len([t.name for t in spark.catalog.listTables("warehouse_test") if t.name.startswith("streaks__")]) == 2
        # a plain table of the name becomes the version before
        spark.range(4).write.saveAsTable("warehouse_test.plain")
        assert create_or_replace(spark.table("warehouse_test.plain").filter("id > 1"), "warehouse_test.plain").count() == 2
    finally:
        spark.sql("DROP DATABASE warehouse_test CASCADE")


def test_broken_tables_are_not_published(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS publishing_test")
    name, declared = "publishing_test.t", {"id": "bigint", "even": "boolean"}
    checks = [q.unique("id"), q.not_null("even"), q.accepted_values("even", [True]).warn()]
    frame = lambda n: spark.range(n).withColumn("even", F.col("id") % 2 == 0)
    versions = lambda: [t.name for t in spark.catalog.listTables("publishing_test") if t.name.startswith("t__")]
    try:
        # nothing is there yet, and a broken first version leaves nothing
        with pytest.raises(q.ChecksFailed, match="unique.id.: 1"):
            publish(frame(3).union(frame(1)), name, declared, checks)
        assert not spark.catalog.tableExists(name) and versions() == []
        # a warning does not hold it back; columns come in declared order
        assert rows(publish(frame(2).select("even", "id"), name, declared, checks)) == [(0, True), (1, False)]
        broken = {
            "extra": (frame(3).withColumn("more", F.lit(1)), ContractBroken),
            "type": (frame(3).withColumn("id", F.col("id").cast("int")), ContractBroken),
            "missing": (frame(3).drop("even"), ContractBroken),
            "null": (frame(3).withColumn("even", F.lit(None).cast("boolean")), q.ChecksFailed),
            "repeated": (spark.table(name).union(spark.table(name)), q.ChecksFailed),
        }
        for df, error in broken.values():
            with pytest.raises(error):
                publish(df, name, declared, checks)
            assert rows(spark.table(name)) == [(0, True), (1, False)] and len(versions()) == 1
        assert publish(frame(0), name, declared, checks).count() == 0
    finally:
        spark.sql("DROP DATABASE publishing_test CASCADE")


def test_replacements_side_by_side(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS parallel_test")
    try:
        create_or_replace(spark.range(1), "parallel_test.t")
        with ThreadPoolExecutor(4) as pool:
            list(pool.map(lambda n: create_or_replace(spark.range(n), "parallel_test.t"), range(2, 8)))
        assert spark.table("parallel_test.t").count() in range(2, 8)
        # the current version and the one before it
        assert len([t.name for t in spark.catalog.listTables("parallel_test") if t.name.startswith("t__")]) == 2
    finally:
        spark.sql("DROP DATABASE parallel_test CASCADE")


def test_landing_counts_bad_payloads(spark, tmp_path):
    football.write(tmp_path)
    payloads = landing.read_payloads(spark, f"{tmp_path}/matches.json")
    parsed = landing.parse(payloads, "matches array<struct<id:long>>")
    assert rows(landing.tally(parsed)) == [(5, 1)]
    assert landing.bad(parsed).select("payload").first()[0].endswith('"utcDa')
    assert landing.good(parsed).select(F.explode("parsed.matches")).count() == 14


def test_one_file_per_response(spark, tmp_path):
    for name, text in {"a": '{\n"areas": [\n{"id": 1}]}', "b": '{"areas": [{"id": 2, "name": "x"}]}'}.items():
        (tmp_path / f"{name}.json").write_text(text)
    payloads = landing.read_payloads(spark, str(tmp_path), whole_file=True)
    assert rows(landing.land(payloads, "areas", schemas.AREA, ["id", "name"])) == [(1, None), (2, "x")]
