"""Staging of the nested raw tables. The SQL states the expected cleaned values directly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import derived as d
from registry import raw
from registry.register import Entry, with_sql
from touchline.plans import contracts, staging
from touchline.operators.contract import enforce_contract

AS_OF = "2001-06-01"


def today() -> Column:
    return F.lit(AS_OF).cast("date")


def as_text(df: DataFrame) -> DataFrame:
    """Dates and lists as text: they compare the same in every client. NULL stays NULL."""
    shown = {}
    for name, dtype in df.dtypes:
        if dtype == "date":
            shown[name] = F.col(name).cast("string")
        elif dtype.startswith("array"):
            shown[name] = F.when(F.col(name).isNotNull(), F.concat_ws(",", F.transform(name, lambda x: F.coalesce(x, F.lit("-")))))
    return df.withColumns(shown) if shown else df


def stage_areas(spark: SparkSession, folder: str) -> DataFrame:
    return enforce_contract(staging.stage_areas(raw.areas(spark, folder)), contracts.AREAS)


STAGED_AREAS = f"""{raw.SQL_AREAS}, staged_areas AS (
  SELECT 'country_' || md5(raw_name) AS country_id, CAST(id AS VARCHAR) AS area_id,
         CASE id WHEN 2030 THEN 'Bosnia-Herzegovina' WHEN 2083 THEN 'North Macedonia' WHEN 2123 THEN 'South Korea'
                 WHEN 2192 THEN 'Ireland' ELSE raw_name END AS country_name, code AS country_code,
         'continent_' || md5(parent) AS continent_id, replace(parent, 'N/C America', 'North America') AS continent_name,
         parent_id AS parent_area_id
  FROM areas)"""
STAGE_AREAS = with_sql(STAGED_AREAS, "FROM staged_areas")


def stage_competitions(spark: SparkSession, folder: str) -> DataFrame:
    return enforce_contract(staging.stage_competitions(raw.competitions(spark, folder)), contracts.COMPETITIONS)


STAGE_COMPETITIONS = f"""
  SELECT DISTINCT CAST(n AS VARCHAR) AS competition_id, substring(p, 3) AS competition_name, 'C' || p[1] AS competition_code,
         CASE WHEN n > 2014 THEN 'league' ELSE 'cup' END AS competition_type, p AS country_name,
         CAST(n * 10000 + 2001 AS VARCHAR) AS current_season_id
  FROM (SELECT o_orderpriority AS p, {d.SQL_COMPETITION} AS n FROM orders) AS found
"""


def stage_matches(spark: SparkSession, folder: str) -> DataFrame:
    staged = staging.stage_matches(raw.matches(spark, folder), today())
    return as_text(enforce_contract(staged, contracts.MATCHES))


_GOALS = ", ".join(
    f"CAST(CASE WHEN o_orderstatus <> 'P' THEN {side}_goals // {part} END AS INTEGER) AS {half}_time_{side}_score"
    for half, part in (("full", 1), ("half", 2))
    for side in ("home", "away")
)
STAGE_MATCHES = with_sql(
    d.SQL_PAIRINGS,
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS match_id, {d.SQL_PLAYED_AT} AS match_at,
               CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'in play' ELSE 'timed' END AS status,
               CAST(o_orderkey % 46 + 1 AS INTEGER) AS matchday_number,
               CASE o_orderkey % 10 WHEN 0 THEN 'final' WHEN 1 THEN 'semi finals' WHEN 2 THEN 'league stage'
                    ELSE 'regular season' END AS stage,
               CAST(home AS VARCHAR) AS home_team_id, CAST(away AS VARCHAR) AS away_team_id,
               CASE WHEN o_orderkey % 13 <> 0 AND o_orderkey % 4 <> 0 THEN
                 (SELECT string_agg(CAST((suppkey + n) % 60 + 80700 AS VARCHAR), ',' ORDER BY n)
                  FROM (VALUES (1), (2), (3)) AS three(n) WHERE n <= o_orderkey % 4) END AS referees_ids,
               CASE WHEN o_orderstatus <> 'P' THEN
                 ['away', 'draw', 'home'][CAST(sign(home_goals - away_goals) AS INTEGER) + 2] END AS winner,
               ['regular', 'extra time', 'penalty shootout'][o_orderkey % 3 + 1] AS duration_type,
               {_GOALS},
               CAST(home + 2020 AS VARCHAR) AS area_id, CAST({d.SQL_COMPETITION} AS VARCHAR) AS competition_id,
               CAST({d.SQL_COMPETITION} * 10000 + year(o_orderdate) AS VARCHAR) AS season_id,
               {d.SQL_PLAYED_AT} + INTERVAL 1 DAY AS last_updated_at
        FROM pairings
        WHERE NOT (o_orderpriority[1] IN ('2', '5') AND year(o_orderdate) = 2000)""",
)


def stage_referees(spark: SparkSession, folder: str) -> DataFrame:
    return enforce_contract(staging.stage_referees(raw.matches(spark, folder)), contracts.REFEREES)


STAGE_REFEREES = with_sql(
    d.SQL_PAIRINGS,
    """SELECT DISTINCT CAST(p + 80700 AS VARCHAR) AS referee_id, 'Referee ' || p AS full_name,
              CASE WHEN p = 47 THEN 'Spain' ELSE 'Nation ' || p % 9 END AS nationality
       FROM (SELECT (suppkey + n) % 60 AS p FROM pairings, (VALUES (1), (2), (3)) AS three(n)
             WHERE n <= o_orderkey % 4 AND o_orderkey % 13 <> 0) AS people""",
)


def stage_teams(spark: SparkSession, folder: str) -> DataFrame:
    return as_text(enforce_contract(staging.stage_teams(raw.teams(spark, folder)), contracts.TEAMS))


_TEAM = """team AS (
  SELECT *, CASE WHEN s_suppkey % 6 = 0 AND s_suppkey % 5 = 4 THEN 2001 ELSE
              [2001, 2013, 2015, 2021, 2152][s_suppkey % 5 + 1] END AS competition,
         CASE s_suppkey % 40 WHEN 9 THEN 'Sheffield United FC' WHEN 18 THEN 'AVS' ELSE s_name END AS team_name
  FROM supplier)"""
STAGE_TEAMS = with_sql(
    _TEAM,
    """SELECT CAST(s_suppkey AS VARCHAR) AS team_id, team_name, 'S' || s_suppkey AS team_short_name,
              upper(left(md5(CAST(s_suppkey AS VARCHAR)), 3)) AS team_code, 'NATION_' || s_nationkey AS country_name,
              'Street ' || s_suppkey AS team_address, 'https://example.org/team/' || s_suppkey AS website_url,
              'https://example.org/crest/' || s_suppkey AS logo_url,
              CASE WHEN s_suppkey % 9 <> 0 THEN (1880 + s_suppkey % 120) || '-01-01'
                   WHEN s_suppkey % 40 = 9 THEN '1889-01-01' WHEN s_suppkey % 40 = 18 THEN '2023-01-01' END
                AS foundation_year_date,
              ['Red', 'Red,White', 'Red,White,Blue', NULL][s_suppkey % 4 + 1] AS team_colors,
              'Arena ' || s_suppkey AS arena_name, CAST(competition AS VARCHAR) AS main_competition_id,
              [NULL, '2001', '2001,2002'][s_suppkey % 3 + 1] AS running_competitions_ids,
              CASE WHEN s_suppkey % 11 <> 0 AND s_suppkey % 15 <> 0 THEN
                (SELECT string_agg(CAST(s_suppkey * 100 + n AS VARCHAR), ',' ORDER BY n)
                 FROM range(1, 15) AS r(n) WHERE n <= s_suppkey % 15) END AS player_ids,
              CAST(s_suppkey // 2 + 5000 AS VARCHAR) AS coach_id,
              CASE WHEN s_suppkey % 10 <> 3 AND s_suppkey % 5 <> 0 THEN
                printf('20%02d-%02d-01', s_suppkey % 20, s_suppkey % 12 + 1) END AS coach_contract_start_date,
              CASE WHEN s_suppkey % 10 <> 3 AND s_suppkey % 7 <> 0 THEN
                printf('20%02d-%02d-01', s_suppkey % 20 + 2, s_suppkey % 12 + 1) END AS coach_contract_end_date,
              CAST(competition * 10000 + 2001 AS VARCHAR) AS season_id
       FROM team""",
)


def stage_coaches(spark: SparkSession, folder: str) -> DataFrame:
    return as_text(enforce_contract(staging.stage_coaches(raw.teams(spark, folder)), contracts.COACHES))


STAGE_COACHES = """
  SELECT CAST(s_suppkey // 2 + 5000 AS VARCHAR) AS coach_id, 'First' || s_suppkey AS first_name,
         'Last' || s_suppkey AS last_name, 'First Last' || s_suppkey AS full_name,
         CAST(DATE '1960-01-01' + CAST(s_suppkey % 9000 AS INTEGER) AS VARCHAR) AS birth_date,
         'N' || s_nationkey AS nationality
  FROM supplier
"""


def stage_seasons(spark: SparkSession, folder: str) -> DataFrame:
    staged = staging.stage_seasons(raw.teams(spark, folder))
    return as_text(enforce_contract(staged, contracts.STAGED_SEASONS))


STAGE_SEASONS = """
  SELECT DISTINCT strip_accents('série_' || c) || '_2001_' || CASE WHEN c = 2013 THEN '2001' ELSE '2002' END AS season_uid,
         CAST(c * 10000 + 2001 AS VARCHAR) AS season_id, '2001-08-01' AS start_date,
         CASE WHEN c = 2013 THEN '2001-12-01' ELSE '2002-05-31' END AS end_date, CAST(c AS VARCHAR) AS competition_id
  FROM (SELECT unnest([[2001, 2013, 2015, 2021, 2152][s_suppkey % 5 + 1],
                       CASE WHEN s_suppkey % 6 = 0 THEN [2001, 2013, 2015, 2021, 2152][(s_suppkey + 1) % 5 + 1] END]) AS c
        FROM supplier) AS found WHERE c IS NOT NULL
"""


def stage_players(spark: SparkSession, folder: str) -> DataFrame:
    staged = staging.stage_players(raw.players(spark, folder))
    return as_text(enforce_contract(staged, contracts.STAGED_PLAYERS))


_MONTH = "printf('20%02d-%02d-01', c_custkey % 20 + 5, c_custkey % 12 + 1)"
STAGED_PLAYERS = f"""staged_players AS (
  SELECT CAST(c_custkey + 191100 AS VARCHAR) AS player_id, c_name AS name, 'F' || c_custkey AS first_name,
         CASE WHEN c_custkey % 10 <> 0 THEN 'L' || c_custkey END AS last_name,
         CASE c_custkey WHEN 6 THEN DATE '2005-01-04' WHEN 27 THEN DATE '1998-05-12' WHEN 711 THEN DATE '1995-01-01'
           ELSE CASE WHEN c_custkey % 17 <> 0 THEN DATE '1970-01-01' + CAST(c_custkey * 37 % 14000 AS INTEGER) END
           END AS date_of_birth,
         CASE WHEN c_custkey = 1552 THEN 'Brazil' WHEN c_custkey % 19 <> 0 THEN
           ['United States', 'Côte d’Ivoire', 'Congo DR', 'United Arab Emirates', 'São Tomé e Príncipe', 'France',
            'Chile'][c_custkey % 7 + 1] END AS nationality,
         ['Offence', 'Defence'][c_custkey % 2 + 1] AS section,
         ['Right Winger', 'Centre-Back'][c_custkey % 2 + 1] AS position,
         CAST(c_custkey % 99 + 1 AS INTEGER) AS player_number, CAST(c_nationkey AS VARCHAR) AS current_team_id,
         CASE WHEN c_custkey % 6 <> 0 THEN {_MONTH} END AS contract_start_month,
         CASE WHEN c_custkey % 6 <> 0 AND c_custkey % 8 <> 0 THEN {_MONTH} END AS contract_end_month,
         TIMESTAMP '2001-06-01 10:00:00' AS last_updated_at
  FROM customer)"""
STAGE_PLAYERS = with_sql(
    STAGED_PLAYERS, "SELECT * REPLACE (CAST(date_of_birth AS VARCHAR) AS date_of_birth) FROM staged_players"
)


ENTRIES = {
    "stage_areas": Entry(stage_areas, STAGE_AREAS),
    "stage_competitions": Entry(stage_competitions, STAGE_COMPETITIONS),
    "stage_matches": Entry(stage_matches, STAGE_MATCHES),
    "stage_referees": Entry(stage_referees, STAGE_REFEREES),
    "stage_teams": Entry(stage_teams, STAGE_TEAMS),
    "stage_coaches": Entry(stage_coaches, STAGE_COACHES),
    "stage_seasons": Entry(stage_seasons, STAGE_SEASONS),
    "stage_players": Entry(stage_players, STAGE_PLAYERS),
}
