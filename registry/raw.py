"""API-shaped raw tables made from the supplied ones, nested as the staging expects them.

Lists are made within a row (``transform`` over a short sequence), never by collecting a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import derived as d
from registry.register import table


def api_time(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def id_struct(value: Column) -> Column:
    return F.struct(value.cast("bigint").alias("id"))


def ids_up_to(count: Column, first: Column) -> Column:
    """``[{first + 1}, {first + 2} ..]``, ``count`` of them."""
    numbers = F.when(count > 0, F.sequence(F.lit(1), count.cast("int"))).otherwise(F.array().cast("array<int>"))
    return F.transform(numbers, lambda n: id_struct(first + n))


def areas(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as areas of their region; one of twelve is called World, one of eight has no parent."""
    key = F.col("c_custkey")
    parent = F.when(F.col("r_name") == "AMERICA", "N/C America").otherwise(
        F.concat(F.substring("r_name", 1, 1), F.lower(F.expr("substring(r_name, 2)")))
    )
    places = (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return places.select(
        (key + 2000).alias("id"),
        F.when(key % 12 == 5, "World").otherwise(F.col("c_name")).alias("name"),
        F.concat(F.lit("C"), (key % 100).cast("string")).alias("countryCode"),
        F.lit(None).cast("string").alias("flag"),
        (F.col("r_regionkey") + 2200).cast("bigint").alias("parentAreaId"),
        F.when(key % 8 != 3, parent).alias("parentArea"),
    )


SQL_AREAS = """areas AS (
  SELECT c_custkey + 2000 AS id, CASE WHEN c_custkey % 12 = 5 THEN 'World' ELSE c_name END AS raw_name,
         'C' || c_custkey % 100 AS code, CAST(r_regionkey + 2200 AS VARCHAR) AS parent_id,
         CASE WHEN c_custkey % 8 = 3 THEN NULL WHEN r_name = 'AMERICA' THEN 'N/C America'
              ELSE upper(r_name[1]) || lower(r_name[2:]) END AS parent
  FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)"""


def competitions(spark: SparkSession, folder: str) -> DataFrame:
    priorities = table(spark, folder, "orders").select("o_orderpriority").distinct()
    number = d.competition_number()
    return priorities.select(
        number.cast("bigint").alias("id"),
        F.struct(F.col("o_orderpriority").alias("name")).alias("area"),
        F.expr("substring(o_orderpriority, 3)").alias("name"),
        F.concat(F.lit("C"), F.substring("o_orderpriority", 1, 1)).alias("code"),
        F.when(number > 2014, "LEAGUE").otherwise("CUP").alias("type"),
        id_struct(number * 10000 + 2001).alias("currentSeason"),
        F.lit("2001-08-01T00:00:00Z").alias("lastUpdated"),
    )


def matches(spark: SparkSession, folder: str) -> DataFrame:
    """One match of seven also has an older row, still scheduled."""
    key = F.col("o_orderkey")
    copies = d.pairings(spark, folder).withColumn("copy", F.explode(F.sequence(F.lit(0), F.when(key % 7 == 0, 1).otherwise(0))))
    older = F.col("copy") == 1
    at = d.played_at()
    status = F.when(older, "SCHEDULED").when(F.col("o_orderstatus") == "F", "FINISHED")
    status = status.when(F.col("o_orderstatus") == "O", "IN_PLAY").otherwise("TIMED")
    tenth = key % 10
    stage = F.when(tenth == 0, "FINAL").when(tenth == 1, "SEMI_FINALS").when(tenth == 2, "LEAGUE_STAGE")
    lead = F.col("home_goals") - F.col("away_goals")
    winner = F.when(lead > 0, "HOME_TEAM").when(lead < 0, "AWAY_TEAM").otherwise("DRAW")
    competition = d.competition_number()

    def referee(number: Column) -> Column:
        person = ((F.col("suppkey") + number) % 60).cast("bigint")
        return F.struct(
            (person + 80700).alias("id"),
            F.concat(F.lit("Referee "), person.cast("string")).alias("name"),
            F.concat(F.lit("Nation "), (person % 9).cast("string")).alias("nationality"),
        )

    count = (key % 4).cast("int")
    numbers = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))

    def score(half: int) -> Column:
        sides = [F.floor(F.col(f"{s}_goals") / half).cast("int").alias(s) for s in ("home", "away")]
        return F.when(F.col("o_orderstatus") != "P", F.struct(*sides)).otherwise(
            F.struct(F.lit(None).cast("int").alias("home"), F.lit(None).cast("int").alias("away"))
        )

    return copies.select(
        key.alias("id"),
        api_time(at).alias("utcDate"),
        status.alias("status"),
        (key % 46 + 1).cast("int").alias("matchday"),
        stage.otherwise("REGULAR_SEASON").alias("stage"),
        api_time(F.when(older, at).otherwise(at + F.expr("INTERVAL 1 DAY"))).alias("lastUpdated"),
        id_struct(F.col("home") + 2020).alias("area"),
        id_struct(competition).alias("competition"),
        id_struct(competition * 10000 + F.year("o_orderdate")).alias("season"),
        id_struct(F.col("home")).alias("homeTeam"),
        id_struct(F.col("away")).alias("awayTeam"),
        F.when(key % 13 != 0, F.transform(numbers, referee)).alias("referees"),
        F.when((F.col("o_orderstatus") != "P") & ~older, winner).alias("winner"),
        F.element_at(F.array(*[F.lit(x) for x in ("REGULAR", "EXTRA_TIME", "PENALTY_SHOOTOUT")]), (key % 3 + 1).cast("int")).alias("duration"),
        score(1).alias("full_time"),
        score(2).alias("half_time"),
    )


def teams(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers; one of six plays in two competitions."""
    key = F.col("s_suppkey")
    rows = table(spark, folder, "supplier").withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.when(key % 6 == 0, 1).otherwise(0)))
    )
    number = ((key + F.col("copy")) % 5).cast("int")
    ids = F.array(*[F.lit(i) for i in sorted(d.COMPETITION_IDS.values())])
    competition = F.element_at(ids, number + 1)
    name = F.when(key % 40 == 9, "Sheffield United FC").when(key % 40 == 18, "AVS").otherwise(F.col("s_name"))
    contract = F.struct(
        F.when(key % 5 != 0, F.format_string("20%02d-%02d", (key % 20).cast("int"), (key % 12 + 1).cast("int"))).alias("start"),
        F.when(key % 7 != 0, F.format_string("20%02d-%02d", (key % 20 + 2).cast("int"), (key % 12 + 1).cast("int"))).alias("until"),
    )
    text = key.cast("string")
    coach = F.struct(
        (F.floor(key / 2) + 5000).cast("bigint").alias("id"),
        F.concat(F.lit("First"), text).alias("firstName"),
        F.concat(F.lit("Last"), text).alias("lastName"),
        F.concat(F.lit("First Last"), text).alias("name"),
        F.date_format(F.date_add(F.lit("1960-01-01").cast("date"), (key % 9000).cast("int")), "yyyy-MM-dd").alias("dateOfBirth"),
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("nationality"),
        F.when(key % 10 != 3, contract).alias("contract"),
    )
    return rows.select(
        key.alias("id"),
        name.alias("name"),
        F.concat(F.lit("S"), text).alias("shortName"),
        F.upper(F.substring(F.md5(text), 1, 3)).alias("tla"),
        F.struct(F.concat(F.lit("NATION_"), F.col("s_nationkey").cast("string")).alias("name")).alias("area"),
        F.concat(F.lit("Street "), text).alias("address"),
        F.concat(F.lit("https://example.org/team/"), text).alias("website"),
        F.concat(F.lit("https://example.org/crest/"), text).alias("crest"),
        F.when(key % 9 != 0, 1880 + key % 120).cast("double").alias("founded"),
        F.when(key % 4 == 0, "Red").when(key % 4 == 1, "Red / White").when(key % 4 == 2, "Red / White / Blue").alias("clubColors"),
        F.concat(F.lit("Arena "), text).alias("venue"),
        F.struct(competition.cast("bigint").alias("id"), F.concat(F.lit("Série "), competition.cast("string")).alias("name")).alias("competition"),
        F.struct(
            (competition * 10000 + 2001).cast("bigint").alias("id"),
            F.lit("2001-08-01").alias("startDate"),
            F.when(competition == 2013, "2001-12-01").otherwise("2002-05-31").alias("endDate"),
        ).alias("season"),
        ids_up_to((key % 3).cast("int"), F.lit(2000)).alias("runningCompetitions"),
        F.when(key % 11 != 0, ids_up_to((key % 15).cast("int"), key * 100)).alias("squad"),
        coach.alias("coach"),
    )


def players(spark: SparkSession, folder: str) -> DataFrame:
    """Customers; ids start where the corrected ones lie."""
    key = F.col("c_custkey")
    names = [F.lit(n) for n in ("USA", "Ivory Coast", "DR Congo", "UA Emirates", "São Tomé and Príncipe", "France", "Chile")]
    month = F.format_string("20%02d-%02d", (key % 20 + 5).cast("int"), (key % 12 + 1).cast("int"))
    born = F.date_add(F.lit("1970-01-01").cast("date"), (key * 37 % 14000).cast("int"))
    return table(spark, folder, "customer").select(
        (key + 191100).alias("id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("F"), key.cast("string")).alias("firstName"),
        F.when(key % 10 != 0, F.concat(F.lit("L"), key.cast("string"))).alias("lastName"),
        F.when(key % 17 != 0, F.date_format(born, "yyyy-MM-dd")).alias("dateOfBirth"),
        F.when(key % 19 != 0, F.element_at(F.array(*names), (key % 7 + 1).cast("int"))).alias("nationality"),
        F.when(key % 2 == 0, "Offence").otherwise("Defence").alias("section"),
        F.when(key % 2 == 0, "Right Winger").otherwise("Centre-Back").alias("position"),
        (key % 99 + 1).cast("int").alias("shirtNumber"),
        F.lit("2001-06-01T10:00:00Z").alias("lastUpdated"),
        F.col("c_nationkey").cast("bigint").alias("current_team_id"),
        F.when(key % 6 != 0, F.struct(month.alias("start"), F.when(key % 8 != 0, month).alias("until"))).alias("player_contract"),
    )
