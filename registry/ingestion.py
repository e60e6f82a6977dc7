"""Landed JSON. The payloads are made from the supplied tables; one in ninety-seven is broken."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import derived as d
from registry import raw
from registry.register import Entry, table, with_sql
from touchline.operators import quality as q
from touchline.operators.contract import ContractBroken
from touchline.plans.publishing import publish
from touchline.sources import landing, schemas
from touchline.session import shared_folder
from touchline.sources.tables import create_or_replace


def match_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """A response per match row, with the score nested the way the API does."""
    score = F.struct("winner", "duration", F.col("full_time").alias("fullTime"), F.col("half_time").alias("halfTime"))
    rows = raw.matches(spark, folder).withColumn("score", score).drop("winner", "duration", "full_time", "half_time")
    body = F.to_json(F.struct(F.array(F.struct("*")).alias("matches")))
    # a response names the same match twice now and then; another breaks off
    twice = F.to_json(F.struct(F.array(F.struct("*"), F.struct("*")).alias("matches")))
    text = F.when(F.col("id") % 97 == 0, F.lit('{"matches": [{"id": ')).when(F.col("id") % 5 == 0, twice).otherwise(body)
    return rows.select(text.alias("payload"))


def land_matches(spark: SparkSession, folder: str) -> DataFrame:
    rows = landing.matches_table(match_payloads(spark, folder), schemas.MATCH)
    return rows.select(
        "id",
        "utcDate",
        "status",
        "lastUpdated",
        F.col("competition.id").alias("competition"),
        F.col("homeTeam.id").alias("home"),
        F.size("referees").cast("bigint").alias("referees"),
        "winner",
        "duration",
        F.col("full_time.home").alias("home_goals"),
        F.col("half_time.away").alias("away_goals_at_half"),
    )


LAND_MATCHES = with_sql(
    d.SQL_PAIRINGS,
    f"""SELECT o_orderkey AS id, strftime({d.SQL_PLAYED_AT}, '%Y-%m-%dT%H:%M:%SZ') AS "utcDate",
               CASE WHEN copy = 1 THEN 'SCHEDULED' WHEN o_orderstatus = 'F' THEN 'FINISHED'
                    WHEN o_orderstatus = 'O' THEN 'IN_PLAY' ELSE 'TIMED' END AS status,
               strftime({d.SQL_PLAYED_AT} + to_days(CAST(1 - copy AS INTEGER)), '%Y-%m-%dT%H:%M:%SZ') AS "lastUpdated",
               CAST({d.SQL_COMPETITION} AS BIGINT) AS competition, CAST(home AS BIGINT) AS home,
               CASE WHEN o_orderkey % 13 <> 0 THEN o_orderkey % 4 END AS referees,
               CASE WHEN o_orderstatus <> 'P' AND copy = 0 THEN
                 CASE WHEN home_goals > away_goals THEN 'HOME_TEAM' WHEN home_goals < away_goals THEN 'AWAY_TEAM'
                      ELSE 'DRAW' END END AS winner,
               ['REGULAR', 'EXTRA_TIME', 'PENALTY_SHOOTOUT'][o_orderkey % 3 + 1] AS duration,
               CAST(CASE WHEN o_orderstatus <> 'P' THEN home_goals END AS INTEGER) AS home_goals,
               CAST(CASE WHEN o_orderstatus <> 'P' THEN away_goals // 2 END AS INTEGER) AS away_goals_at_half
        FROM pairings, (VALUES (0), (1)) AS copies(copy)
        WHERE (copy = 0 OR o_orderkey % 7 = 0) AND o_orderkey % 97 <> 0""",
)


def landing_tally(spark: SparkSession, folder: str) -> DataFrame:
    parsed = landing.parse(match_payloads(spark, folder), "matches array<struct<id:long>>")
    return landing.tally(parsed)


LANDING_TALLY = with_sql(
    d.SQL_PAIRINGS,
    """SELECT count(*) FILTER (o_orderkey % 97 <> 0) AS good, count(*) FILTER (o_orderkey % 97 = 0) AS bad
       FROM pairings, (VALUES (0), (1)) AS copies(copy) WHERE copy = 0 OR o_orderkey % 7 = 0""",
)


def landing_bad(spark: SparkSession, folder: str) -> DataFrame:
    """The payloads that could not be read, as they came."""
    parsed = landing.parse(match_payloads(spark, folder), "matches array<struct<id:long>>")
    return landing.bad(parsed).groupBy("payload").agg(F.count(F.lit(1)).alias("n"))


LANDING_BAD = with_sql(
    d.SQL_PAIRINGS,
    """SELECT '{"matches": [{"id": ' AS payload, count(*) AS n
       FROM pairings, (VALUES (0), (1)) AS copies(copy)
       WHERE (copy = 0 OR o_orderkey % 7 = 0) AND o_orderkey % 97 = 0 HAVING n > 0""",
)


def land_teams(spark: SparkSession, folder: str) -> DataFrame:
    """Competition and season of the response set beside each team, the season without its winner."""
    rows = raw.teams(spark, folder)
    season = F.col("season").withField("winner", F.struct(F.col("id").alias("id")))
    team = F.struct(*[name for name in rows.columns if name not in ("competition", "season")])
    body = F.struct(F.col("competition"), season.alias("season"), F.array(team).alias("teams"))
    payloads = rows.select(F.to_json(body).alias("payload"))
    landed = landing.teams_table(payloads, schemas.TEAM, schemas.TEAM_PARENTS)
    return landed.select(
        "id",
        "name",
        F.col("competition.id").alias("competition"),
        F.to_json("season").alias("season"),
        F.col("coach.contract.until").alias("until"),
        F.size("squad").cast("bigint").alias("players"),
    )


LAND_TEAMS = """
  SELECT s_suppkey AS id, CASE s_suppkey % 40 WHEN 9 THEN 'Sheffield United FC' WHEN 18 THEN 'AVS' ELSE s_name END AS name,
         CAST(c AS BIGINT) AS competition,
         '{"id":' || (c * 10000 + 2001) || ',"startDate":"2001-08-01","endDate":"' ||
           CASE WHEN c = 2013 THEN '2001-12-01' ELSE '2002-05-31' END || '"}' AS season,
         CASE WHEN s_suppkey % 10 <> 3 AND s_suppkey % 7 <> 0 THEN
           printf('20%02d-%02d', s_suppkey % 20 + 2, s_suppkey % 12 + 1) END AS until,
         CASE WHEN s_suppkey % 11 <> 0 THEN s_suppkey % 15 END AS players
  FROM supplier, (VALUES (0), (1)) AS copies(copy),
       LATERAL (SELECT [2001, 2013, 2015, 2021, 2152][(s_suppkey + copy) % 5 + 1]) AS chosen(c)
  WHERE copy = 0 OR s_suppkey % 6 = 0
"""


def land_players(spark: SparkSession, folder: str) -> DataFrame:
    """One object per response; the error responses have no current team."""
    people = raw.players(spark, folder)
    team = F.struct(F.col("current_team_id").alias("id"), F.col("player_contract").alias("contract"), F.lit("x").alias("name"))
    kept = [F.col(name) for name in people.columns if name not in ("current_team_id", "player_contract")]
    body = F.to_json(F.struct(*kept, team.alias("currentTeam"), F.lit("y").alias("unused")))
    error = F.lit('{"message": "not found", "errorCode": 404}')
    payloads = people.select(F.when(F.col("id") % 23 != 0, body).otherwise(error).alias("payload"))
    landed = landing.players_table(payloads, schemas.PERSON)
    return landed.select("id", "name", "nationality", "current_team_id", F.to_json("player_contract").alias("contract"))


LAND_PLAYERS = """
  SELECT c_custkey + 191100 AS id, c_name AS name,
         CASE WHEN c_custkey % 19 <> 0 THEN
           ['USA', 'Ivory Coast', 'DR Congo', 'UA Emirates', 'São Tomé and Príncipe', 'France', 'Chile']
             [c_custkey % 7 + 1] END AS nationality,
         CAST(c_nationkey AS BIGINT) AS current_team_id,
         CASE WHEN c_custkey % 6 <> 0 THEN
           '{"start":"' || month || '"' || CASE WHEN c_custkey % 8 <> 0 THEN ',"until":"' || month || '"' ELSE '' END || '}'
         END AS contract
  FROM (SELECT *, printf('20%02d-%02d', c_custkey % 20 + 5, c_custkey % 12 + 1) AS month FROM customer) AS c
  WHERE (c_custkey + 191100) % 23 <> 0
"""


def concat_pages(spark: SparkSession, folder: str) -> DataFrame:
    """One page lacks a column, another has one more."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    pages = [
        orders.filter("o_orderstatus = 'F'"),
        orders.filter("o_orderstatus = 'O'").drop("o_orderpriority"),
        orders.filter("o_orderstatus = 'P'").withColumn("note", F.lit("open")),
    ]
    return landing.concat_pages(pages)


CONCAT_PAGES = """
  SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END AS o_orderpriority,
         CASE WHEN o_orderstatus = 'P' THEN 'open' END AS note
  FROM orders
"""


def replaced_table(spark: SparkSession, folder: str) -> DataFrame:
    """A table written, then replaced with something made of itself."""
    first = create_or_replace(d.matches(spark, folder), "replaced_matches")
    return create_or_replace(first.filter("status = 'finished'"), "replaced_matches")


def published_table(spark: SparkSession, folder: str) -> DataFrame:
    """A table that two replacements leave as it was: one breaks a check, the other the contract."""
    name = f"published_{uuid.uuid4().hex}"
    declared = {"o_orderkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double"}
    checks = [
        q.unique("o_orderkey"),
        q.not_null("o_orderstatus"),
        q.accepted_range("o_totalprice", 0),
        q.accepted_values("o_orderstatus", ["F"]).warn(),
    ]
    first = publish(table(spark, folder, "orders").select(*declared), name, declared, checks)
    twice = first.unionByName(first.filter("o_orderstatus = 'F'"))
    as_text = first.withColumn("o_orderkey", F.col("o_orderkey").cast("string"))
    for broken, error in ((twice, q.ChecksFailed), (as_text, ContractBroken)):
        with contextlib.suppress(error):
            publish(broken, name, declared, checks)
            raise AssertionError("a broken table was published")
    return spark.table(name)


PUBLISHED_TABLE = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders"


def landed_files(spark: SparkSession, folder: str) -> DataFrame:
    """The responses as files of one line each response, read, parsed and counted."""
    path = f"{shared_folder(spark)}/responses-{uuid.uuid4().hex}"
    match_payloads(spark, folder).select(F.col("payload").alias("value")).write.text(path)
    parsed = landing.parse(landing.read_payloads(spark, path), "matches array<struct<id:long, status:string>>")
    landed = landing.good(parsed).select(F.explode("parsed.matches").alias("m")).select("m.*").distinct()
    by_status = landed.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    return by_status.union(landing.bad(parsed).agg(F.lit("unreadable"), F.count(F.lit(1))))


LANDED_FILES = with_sql(
    d.SQL_PAIRINGS,
    """landed AS (
         SELECT DISTINCT o_orderkey, CASE WHEN copy = 1 THEN 'SCHEDULED' WHEN o_orderstatus = 'F' THEN 'FINISHED'
                  WHEN o_orderstatus = 'O' THEN 'IN_PLAY' ELSE 'TIMED' END AS status
         FROM pairings, (VALUES (0), (1)) AS copies(copy)
         WHERE (copy = 0 OR o_orderkey % 7 = 0) AND o_orderkey % 97 <> 0)""",
    """SELECT status, count(*) AS n FROM landed GROUP BY status
       UNION ALL SELECT 'unreadable', count(*) FROM pairings, (VALUES (0), (1)) AS copies(copy)
       WHERE (copy = 0 OR o_orderkey % 7 = 0) AND o_orderkey % 97 = 0""",
)


REPLACED_TABLE = with_sql(d.SQL_MATCHES, "FROM matches WHERE status = 'finished'")


ENTRIES = {
    "land_matches": Entry(land_matches, LAND_MATCHES),
    "land_teams": Entry(land_teams, LAND_TEAMS),
    "land_players": Entry(land_players, LAND_PLAYERS),
    "landing_tally": Entry(landing_tally, LANDING_TALLY),
    "landing_bad": Entry(landing_bad, LANDING_BAD),
    "concat_pages": Entry(concat_pages, CONCAT_PAGES),
    "landed_files": Entry(landed_files, LANDED_FILES),
    "published_table": Entry(published_table, PUBLISHED_TABLE),
    "replaced_table": Entry(replaced_table, REPLACED_TABLE),
}
