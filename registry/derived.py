"""Matches, teams, competitions and seasons made from the supplied tables.

An order is a match: customer nation at home, supplier nation away, priority the competition,
year the season, line return flags the goals. Below, each frame stands beside the SQL that
makes the same table for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registry.register import table
from touchline.sources.tables import scratch_table

# first letter of the order priority -> competition id
COMPETITION_IDS = {"1": 2001, "2": 2013, "3": 2021, "4": 2015, "5": 2152}


def competition_number(priority: str = "o_orderpriority") -> Column:
    letter = F.substring(priority, 1, 1)
    found = F.when(letter == "1", 2001).when(letter == "2", 2013).when(letter == "3", 2021)
    return found.when(letter == "4", 2015).otherwise(2152)


SQL_COMPETITION = (
    "CASE left(o_orderpriority, 1) WHEN '1' THEN 2001 WHEN '2' THEN 2013 WHEN '3' THEN 2021 "
    "WHEN '4' THEN 2015 ELSE 2152 END"
)


def played_at() -> Column:
    seconds = (F.col("o_orderkey") % 86400).cast("int")
    return F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


SQL_PLAYED_AT = "o_orderdate + to_seconds(o_orderkey % 86400)"


def pairings(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the two nations and the goals."""
    lines = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("suppkey"),
        F.count_if(F.col("l_returnflag") == "R").cast("int").alias("home_goals"),
        F.count_if(F.col("l_returnflag") == "N").cast("int").alias("away_goals"),
    )
    orders = table(spark, folder, "orders").drop("o_totalprice")
    customers = table(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").alias("home"))
    suppliers = table(spark, folder, "supplier").select("s_suppkey", F.col("s_nationkey").alias("away"))
    return (
        orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(suppliers, F.col("suppkey") == F.col("s_suppkey"))
        .filter("home <> away")
        .drop("l_orderkey", "c_custkey", "s_suppkey", "o_custkey")
    )


SQL_PAIRINGS = """pairings AS (
  SELECT o_orderkey, o_orderstatus, o_orderdate, o_orderpriority, suppkey,
         c_nationkey AS home, s_nationkey AS away, home_goals, away_goals
  FROM (SELECT l_orderkey, min(l_suppkey) AS suppkey,
               count(*) FILTER (l_returnflag = 'R') AS home_goals,
               count(*) FILTER (l_returnflag = 'N') AS away_goals
        FROM lineitem GROUP BY l_orderkey) AS line
  JOIN orders ON o_orderkey = l_orderkey
  JOIN customer ON c_custkey = o_custkey
  JOIN supplier ON s_suppkey = suppkey
  WHERE c_nationkey <> s_nationkey)"""


def matches(spark: SparkSession, folder: str) -> DataFrame:
    open_match = F.col("o_orderstatus") == "P"
    lead = F.col("home_goals") - F.col("away_goals")
    tenth = F.col("o_orderkey") % 10
    stage = F.when(tenth == 0, "final").when(tenth == 1, "semi finals").when(tenth == 2, "quarter finals")
    stage = stage.when(tenth == 3, "league stage").otherwise("regular season")
    status = F.when(F.col("o_orderstatus") == "F", "finished").when(F.col("o_orderstatus") == "O", "awarded")
    competition = competition_number()
    return pairings(spark, folder).select(
        F.col("o_orderkey").cast("string").alias("match_id"),
        played_at().alias("match_at"),
        status.otherwise("timed").alias("status"),
        (F.col("o_orderkey") % 46 + 1).cast("int").alias("matchday_number"),
        stage.alias("stage"),
        F.col("home").cast("string").alias("home_team_id"),
        F.col("away").cast("string").alias("away_team_id"),
        competition.cast("string").alias("competition_id"),
        F.concat(competition.cast("string"), F.year("o_orderdate").cast("string")).alias("season_id"),
        F.when(open_match, None).when(lead > 0, "home").when(lead < 0, "away").otherwise("draw").alias("winner"),
        F.when(~open_match, F.col("home_goals")).alias("full_time_home_score"),
        F.when(~open_match, F.col("away_goals")).alias("full_time_away_score"),
    )


def stored_matches(spark: SparkSession, folder: str) -> DataFrame:
    """The matches as a table of their own, for queries that read them more than once.

    The size checks of ordered groups read the keys first: out of a table that is a column
    scan, while the joins behind the matches would be done twice.
    """
    return scratch_table(matches(spark, folder), "matches")


SQL_MATCHES = f"""{SQL_PAIRINGS}, matches AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS match_id, {SQL_PLAYED_AT} AS match_at,
         CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'awarded' ELSE 'timed' END AS status,
         CAST(o_orderkey % 46 + 1 AS INTEGER) AS matchday_number,
         CASE o_orderkey % 10 WHEN 0 THEN 'final' WHEN 1 THEN 'semi finals' WHEN 2 THEN 'quarter finals'
              WHEN 3 THEN 'league stage' ELSE 'regular season' END AS stage,
         CAST(home AS VARCHAR) AS home_team_id, CAST(away AS VARCHAR) AS away_team_id,
         CAST({SQL_COMPETITION} AS VARCHAR) AS competition_id,
         CAST({SQL_COMPETITION} AS VARCHAR) || CAST(year(o_orderdate) AS VARCHAR) AS season_id,
         CASE WHEN o_orderstatus = 'P' THEN NULL WHEN home_goals > away_goals THEN 'home'
              WHEN home_goals < away_goals THEN 'away' ELSE 'draw' END AS winner,
         CAST(CASE WHEN o_orderstatus <> 'P' THEN home_goals END AS INTEGER) AS full_time_home_score,
         CAST(CASE WHEN o_orderstatus <> 'P' THEN away_goals END AS INTEGER) AS full_time_away_score
  FROM pairings)"""


def teams(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("n_nationkey").cast("string")
    home = F.col("n_nationkey") % 5
    main = F.when(home == 0, "2001").when(home == 1, "2013").when(home == 2, "2021").when(home == 3, "2015")
    return table(spark, folder, "nation").select(
        key.alias("team_id"),
        F.col("n_name").alias("team_name"),
        F.concat(F.lit("N"), key).alias("team_short_name"),
        F.concat(F.lit("https://example.org/"), key, F.lit(".png")).alias("logo_url"),
        main.otherwise("2152").alias("main_competition_id"),
    )


SQL_TEAMS = """teams AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS team_id, n_name AS team_name, 'N' || n_nationkey AS team_short_name,
         'https://example.org/' || n_nationkey || '.png' AS logo_url,
         ['2001', '2013', '2021', '2015', '2152'][n_nationkey % 5 + 1] AS main_competition_id
  FROM nation)"""


def competitions(spark: SparkSession, folder: str) -> DataFrame:
    """Written out like any dimension table: then Spark knows its size and may broadcast it."""
    priorities = table(spark, folder, "orders").select("o_orderpriority").distinct()
    found = priorities.select(
        competition_number().cast("string").alias("competition_id"),
        F.expr("substring(o_orderpriority, 3)").alias("competition_name"),
    )
    return scratch_table(found, "competitions")


SQL_COMPETITIONS = f"""competitions AS (
  SELECT DISTINCT CAST({SQL_COMPETITION} AS VARCHAR) AS competition_id,
         substring(o_orderpriority, 3) AS competition_name
  FROM orders)"""


def staged_seasons(spark: SparkSession, folder: str) -> DataFrame:
    """Seasons from January to December, or to the next year's June outside the single-year league."""
    found = table(spark, folder, "orders").select(
        competition_number().alias("competition"), F.year("o_orderdate").alias("year")
    )
    competition, year = F.col("competition"), F.col("year")
    end = F.when(competition == 2013, F.make_date(year, F.lit(12), F.lit(31)))
    distinct = found.distinct().select(
        F.concat(competition.cast("string"), year.cast("string")).alias("season_id"),
        F.make_date(year, F.lit(1), F.lit(1)).alias("start_date"),
        end.otherwise(F.make_date(year + 1, F.lit(6), F.lit(30))).alias("end_date"),
        competition.cast("string").alias("competition_id"),
    )
    return scratch_table(distinct, "seasons")


SQL_STAGED_SEASONS = f"""staged_seasons AS (
  SELECT competition || '' || y AS season_id, make_date(y, 1, 1) AS start_date,
         CASE WHEN competition = 2013 THEN make_date(y, 12, 31) ELSE make_date(y + 1, 6, 30) END AS end_date,
         CAST(competition AS VARCHAR) AS competition_id
  FROM (SELECT DISTINCT {SQL_COMPETITION} AS competition, year(o_orderdate) AS y FROM orders) AS found)"""

SQL_SEASONS = f"""{SQL_STAGED_SEASONS}, seasons AS (
  SELECT season_id, start_date, end_date, competition_id, competition_name,
         format('{{}} {{}}{{}}', competition_name, year(start_date),
                CASE WHEN competition_id <> '2013' THEN ' - ' || year(end_date) ELSE '' END) AS season_name
  FROM staged_seasons LEFT JOIN competitions USING (competition_id))"""

# two rows per match, the shape most facts start from
SQL_SIDES = """sides AS (
  SELECT m.*, v.venue, v.team_id, v.opponent_id, v.goals, v.against,
         CASE WHEN winner = 'draw' THEN 'draw' WHEN winner = venue THEN 'win'
              WHEN winner IS NOT NULL THEN 'loss' END AS result
  FROM matches AS m,
       LATERAL (VALUES ('home', home_team_id, away_team_id, full_time_home_score, full_time_away_score),
                       ('away', away_team_id, home_team_id, full_time_away_score, full_time_home_score))
               AS v(venue, team_id, opponent_id, goals, against))"""
