"""Dimensions, calendars, period lists and orphans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import derived as d
from registry import raw, staged
from registry.register import Entry, table, with_sql
from touchline.operators import dims
from touchline.operators.calendar import calendar, periods
from touchline.operators.contract import enforce_contract
from touchline.plans import contracts, staging
from touchline.plans import values as v


def countries(spark: SparkSession, folder: str) -> DataFrame:
    return dims.countries(staging.stage_areas(raw.areas(spark, folder)))


COUNTRIES = with_sql(
    staged.STAGED_AREAS,
    """SELECT country_id, area_id, country_name, country_code, continent_id
       FROM staged_areas WHERE country_name <> 'World'""",
)


def continents(spark: SparkSession, folder: str) -> DataFrame:
    return dims.continents(staging.stage_areas(raw.areas(spark, folder)))


CONTINENTS = with_sql(
    staged.STAGED_AREAS,
    """SELECT continent_id, continent_name FROM staged_areas
       WHERE continent_id IS NOT NULL AND continent_name <> 'World' GROUP BY ALL""",
)


def season_names(spark: SparkSession, folder: str) -> DataFrame:
    found = dims.seasons(d.staged_seasons(spark, folder), d.competitions(spark, folder), [v.BRAZILIAN_LEAGUE])
    return staged.as_text(enforce_contract(found, contracts.SEASONS))


SEASON_NAMES = with_sql(
    d.SQL_COMPETITIONS,
    d.SQL_SEASONS,
    """SELECT * REPLACE (CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date)
       FROM seasons""",
)


def players(spark: SparkSession, folder: str) -> DataFrame:
    people = staging.stage_players(raw.players(spark, folder))
    found = dims.players(people, d.teams(spark, folder), d.competitions(spark, folder), staged.today())
    return staged.as_text(enforce_contract(found, contracts.PLAYERS))


PLAYERS = with_sql(
    staged.STAGED_PLAYERS,
    d.SQL_TEAMS,
    d.SQL_COMPETITIONS,
    f"""SELECT player_id, name, CAST(date_of_birth AS VARCHAR) AS date_of_birth,
               date_sub('year', date_of_birth, DATE '{staged.AS_OF}') AS age, nationality, section, position,
               player_number, team_id, team_name, main_competition_id AS competition_id, competition_name,
               contract_start_month, contract_end_month
        FROM staged_players LEFT JOIN teams ON team_id = current_team_id
        LEFT JOIN competitions ON competition_id = main_competition_id""",
)


def calendar_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The calendar over the days that have orders at either end, with the orders of each day."""
    orders = table(spark, folder, "orders")
    first, last = orders.agg(F.min("o_orderdate"), F.max("o_orderdate") + F.expr("INTERVAL 1 DAY")).first()
    daily = orders.groupBy(F.to_date("o_orderdate").cast("timestamp_ntz").alias("date_day")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    return calendar(spark, first.date(), last.date()).join(daily, "date_day", "left")


CALENDAR_ORDERS = """
  SELECT CAST(day AS TIMESTAMP) AS date_day, weekofyear(day) AS date_week,
         CAST(day - to_days(CAST(isodow(day) - 1 AS INTEGER)) AS TIMESTAMP) AS week_start_date,
         CAST(day + to_days(CAST(7 - isodow(day) AS INTEGER)) AS TIMESTAMP) AS week_end_date,
         month(day) AS date_month, monthname(day) AS month_name, left(monthname(day), 3) AS month_short_name,
         year(day) AS date_year, orders
  FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS day FROM orders) AS days
  LEFT JOIN (SELECT date_trunc('day', o_orderdate) AS of_day, count(*) AS orders FROM orders GROUP BY 1) AS daily
    ON of_day = day
"""


def periods_10d(spark: SparkSession, folder: str) -> DataFrame:
    """Ten-day periods from the first to the last order day, with the orders in each."""
    orders = table(spark, folder, "orders")
    first, last = orders.agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    number = F.floor(F.datediff(F.to_date("o_orderdate"), F.lit(first.date())) / 10).cast("bigint")
    counts = orders.groupBy(number.alias("period_number")).agg(F.count(F.lit(1)).alias("orders"))
    found = periods(spark, first.date(), last.date()).join(counts, "period_number", "left")
    return staged.as_text(found)


PERIODS_10D = """
  WITH starts AS (
    SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 10 DAYS)) AS s FROM orders),
  counted AS (
    SELECT s, count(o_orderkey) AS n FROM starts
    LEFT JOIN orders ON o_orderdate >= s AND o_orderdate < s + INTERVAL 10 DAYS GROUP BY s)
  SELECT row_number() OVER (ORDER BY s) - 1 AS period_number, CAST(CAST(s AS DATE) AS VARCHAR) AS start_date,
         CAST(CAST(s + INTERVAL 10 DAYS AS DATE) AS VARCHAR) AS end_date, nullif(n, 0) AS orders
  FROM counted
"""


def orphans_anti_join(spark: SparkSession, folder: str) -> DataFrame:
    """Matches whose away team is not in the team table (one region is taken out of it)."""
    known = table(spark, folder, "nation").filter("n_regionkey <> 2").withColumnRenamed("n_nationkey", "id")
    lost = dims.orphans(d.matches(spark, folder), known, "away_team_id", "id")
    named = lost.join(d.competitions(spark, folder), "competition_id", "left")
    return named.select("competition_name", "match_id", "match_at", "home_team_id", "away_team_id", "winner")


ORPHANS = with_sql(
    d.SQL_MATCHES,
    d.SQL_COMPETITIONS,
    """SELECT competition_name, match_id, match_at, home_team_id, away_team_id, winner
       FROM matches LEFT JOIN competitions USING (competition_id)
       WHERE NOT EXISTS (FROM nation WHERE n_regionkey <> 2 AND CAST(n_nationkey AS VARCHAR) = away_team_id)""",
)


ENTRIES = {
    "countries": Entry(countries, COUNTRIES),
    "continents": Entry(continents, CONTINENTS),
    "season_names": Entry(season_names, SEASON_NAMES),
    "players": Entry(players, PLAYERS),
    "calendar": Entry(calendar_orders, CALENDAR_ORDERS),
    "periods_10d": Entry(periods_10d, PERIODS_10D),
    "orphans_anti_join": Entry(orphans_anti_join, ORPHANS),
}
