"""Data checks on tables that break them; each query returns the failures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import derived as d
from registry.register import Entry, table, with_sql
from touchline.functions import list_length
from touchline.operators import quality as q
from touchline.operators import sides
from touchline.operators.contract import enforce_contract
from touchline.operators.ordered import previous


def _sides(spark: SparkSession, folder: str) -> DataFrame:
    return sides.per_side(d.matches(spark, folder)).select("match_id", "team_id", "match_status", "team_result")


_SQL_SIDES = [
    d.SQL_MATCHES,
    d.SQL_SIDES,
    "rows AS (SELECT match_id, team_id, status AS match_status, result AS team_result FROM sides)",
]


def not_null(spark: SparkSession, folder: str) -> DataFrame:
    return q.not_null("team_result", where="match_status = 'timed'").failing(_sides(spark, folder))


NOT_NULL = with_sql(*_SQL_SIDES, "FROM rows WHERE match_status = 'timed' AND team_result IS NULL")


def unique(spark: SparkSession, folder: str) -> DataFrame:
    return q.unique("l_orderkey", where="l_quantity > 25").failing(table(spark, folder, "lineitem"))


UNIQUE = """
  SELECT l_orderkey, count(*) AS rows FROM lineitem
  WHERE l_quantity > 25 AND l_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1
"""


def unique_combination(spark: SparkSession, folder: str) -> DataFrame:
    return q.unique_combination(["l_orderkey", "l_linenumber"]).failing(table(spark, folder, "lineitem"))


UNIQUE_COMBINATION = """
  SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1
"""


def _events(spark: SparkSession, folder: str) -> DataFrame:
    """Some types, values and users unknown."""
    events = table(spark, folder, "events").drop("props")
    return events.withColumns(
        {
            "event_type": F.when(F.col("event_id") % 50 != 0, F.col("event_type")),
            "cents": F.when(F.col("event_id") % 9 != 0, F.round(F.col("value") * 100).cast("bigint")),
            "user_id": F.when(F.col("event_id") % 31 != 0, F.col("user_id")),
        }
    ).drop("value")


_EVENTS = """facts AS (
  SELECT event_id, ts, CASE WHEN event_id % 50 <> 0 THEN event_type END AS event_type,
         CASE WHEN event_id % 9 <> 0 THEN CAST(round(value * 100) AS BIGINT) END AS cents,
         CASE WHEN event_id % 31 <> 0 THEN user_id END AS user_id
  FROM events)"""


def accepted_values(spark: SparkSession, folder: str) -> DataFrame:
    return q.accepted_values("event_type", ["view", "click", "signup"]).failing(_events(spark, folder))


ACCEPTED_VALUES = with_sql(_EVENTS, "FROM facts WHERE event_type NOT IN ('view', 'click', 'signup')")


def accepted_range(spark: SparkSession, folder: str) -> DataFrame:
    upper = F.col("event_id") * 2
    return q.accepted_range("cents", 100, upper, where="event_type = 'view'").failing(_events(spark, folder))


ACCEPTED_RANGE = with_sql(
    _EVENTS, "FROM facts WHERE event_type = 'view' AND NOT cents BETWEEN 100 AND event_id * 2"
)


def accepted_range_open(spark: SparkSession, folder: str) -> DataFrame:
    return q.accepted_range("l_quantity", 1, 50, inclusive=False).failing(
        table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    )


ACCEPTED_RANGE_OPEN = """
  SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity <= 1 OR l_quantity >= 50
"""


def relationships(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part")
    check = q.relationships("l_partkey", parts, "p_partkey", where="l_returnflag <> 'A'", parent_where="p_size < 40")
    return check.failing(table(spark, folder, "lineitem"))


RELATIONSHIPS = """
  SELECT l_partkey AS value, count(*) AS failures FROM lineitem
  WHERE l_returnflag <> 'A' AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 40) GROUP BY 1
"""


def expression_is_true(spark: SparkSession, folder: str) -> DataFrame:
    check = q.expression_is_true("cents > event_id", where="event_type = 'purchase'")
    return check.failing(_events(spark, folder))


EXPRESSION_IS_TRUE = with_sql(_EVENTS, "FROM facts WHERE event_type = 'purchase' AND cents <= event_id")


def lengths(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return q.length_between("text", 100, 5000, where="lang <> 'en'").failing(documents).select("doc_id", "lang")


LENGTHS = "SELECT doc_id, lang FROM documents WHERE lang <> 'en' AND NOT length(text) BETWEEN 100 AND 5000"


def length_equals(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part").select("p_partkey", "p_brand")
    return q.length_equals("p_brand", 7, where="p_partkey % 3 <> 0").failing(parts)


LENGTH_EQUALS = "SELECT p_partkey, p_brand FROM part WHERE p_partkey % 3 <> 0 AND length(p_brand) <> 7"


def pair_greater(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    shipped = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("shipped"))
    both = orders.join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")
    return q.greater_than("shipped", "o_orderdate", or_equal=True).failing(both)


PAIR_GREATER = """
  SELECT o_orderkey, o_orderdate, min(l_shipdate) AS shipped
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL HAVING min(l_shipdate) < o_orderdate
"""


def _keys_list(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    unknown = F.when(F.col("l_partkey") % 17 != 0, F.col("l_suppkey"))
    return lines.withColumn("ids", F.slice(F.array("l_partkey", unknown, "l_orderkey"), 1, (F.col("l_orderkey") % 4).cast("int")))


_LISTS = """lists AS (
  SELECT l_orderkey, l_partkey, l_suppkey,
         [l_partkey, CASE WHEN l_partkey % 17 <> 0 THEN l_suppkey END, l_orderkey][1:l_orderkey % 4] AS ids
  FROM lineitem)"""


def list_relationships(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part")
    return q.list_relationships("ids", parts, "p_partkey").failing(_keys_list(spark, folder))


LIST_RELATIONSHIPS = with_sql(
    _LISTS,
    """SELECT value, count(*) AS failures FROM (SELECT unnest(ids) AS value FROM lists) AS opened
       WHERE NOT EXISTS (FROM part WHERE p_partkey = value) GROUP BY value""",
)


def min_list_length(spark: SparkSession, folder: str) -> DataFrame:
    found = q.min_list_length("ids", 2, or_equal=True).failing(_keys_list(spark, folder))
    return found.withColumn("ids", list_length("ids"))


MIN_LIST_LENGTH = with_sql(_LISTS, "SELECT * REPLACE (len(ids) AS ids) FROM lists WHERE len(ids) < 2")


def equal_counts(spark: SparkSession, folder: str) -> DataFrame:
    return q.equal_counts("event_type", "view", "click").failing(_events(spark, folder))


EQUAL_COUNTS = with_sql(
    _EVENTS,
    """counted AS (SELECT event_type AS value, count(*) AS rows FROM facts
                     WHERE event_type IN ('view', 'click') GROUP BY event_type)""",
    "FROM counted WHERE (SELECT count(DISTINCT rows) FROM counted) > 1",
)


def minimum_after(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return q.minimum_after("o_orderdate", F.expr("timestamp_ntz'2025-06-01' - INTERVAL 30 YEARS")).failing(orders)


MINIMUM_AFTER = """
  SELECT o_orderkey, o_orderdate FROM orders
  WHERE (SELECT min(o_orderdate) FROM orders) <= TIMESTAMP '2025-06-01' - INTERVAL 30 YEARS
"""


def _periods(spark: SparkSession, folder: str) -> DataFrame:
    """An event lasts as many minutes as its value; some are instants, some have no end."""
    minutes = F.when(F.col("event_id") % 8 == 0, 0).otherwise(F.coalesce("cents", F.lit(0)) * 60)
    end = F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), minutes)
    return _events(spark, folder).withColumn("until", F.when(F.col("event_id") % 13 != 0, end))


_PERIODS = f"""{_EVENTS}, periods AS (
  SELECT *, CASE WHEN event_id % 13 <> 0 THEN
           ts + to_seconds(CASE WHEN event_id % 8 = 0 THEN 0 ELSE coalesce(cents, 0) * 60 END) END AS until
  FROM facts)"""


def no_overlap(spark: SparkSession, folder: str) -> DataFrame:
    check = q.no_overlapping_periods("ts", "until", "event_id", ["user_id", "event_type"])
    return check.failing(_periods(spark, folder))


NO_OVERLAP = with_sql(
    _PERIODS,
    """SELECT * FROM periods AS p WHERE EXISTS (
         FROM periods AS o WHERE o.user_id = p.user_id AND o.event_type = p.event_type AND o.event_id <> p.event_id
           AND p.ts < o.until AND p.until > o.ts)""",
)


def not_null_but_latest(spark: SparkSession, folder: str) -> DataFrame:
    return q.not_null_but_latest("cents", ["user_id"], "ts").failing(_events(spark, folder))


NOT_NULL_BUT_LATEST = with_sql(
    _EVENTS, "FROM facts WHERE cents IS NULL QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) <> 1"
)


def scan_is_true(spark: SparkSession, folder: str) -> DataFrame:
    check = q.scan_is_true(
        "cents >= cents_before", ["user_id"], ["ts", "event_id"], {"cents_before": previous("cents")}, where="event_type = 'view'"
    )
    return check.failing(_events(spark, folder))


SCAN_IS_TRUE = with_sql(
    _EVENTS,
    """FROM (FROM facts WHERE event_type = 'view') AS views
       QUALIFY cents < lag(cents) OVER (PARTITION BY user_id ORDER BY ts, event_id)""",
)


def no_element_after(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.array("l_shipdate", F.col("l_shipdate") + F.expr("INTERVAL 30 DAYS")).alias("dates")
    )
    check = q.no_element_after("dates", F.lit("2001-10-01").cast("timestamp_ntz"), "at")
    return check.failing(lines)


NO_ELEMENT_AFTER = """
  FROM (SELECT l_orderkey, l_linenumber, unnest([l_shipdate, l_shipdate + INTERVAL 30 DAYS]) AS at FROM lineitem) AS opened
  WHERE at > TIMESTAMP '2001-10-01'
""".replace(" AS at ", " AS \"at\" ").replace("WHERE at", "WHERE \"at\"")


def contract(spark: SparkSession, folder: str) -> DataFrame:
    """A table whose declared columns hold, in declared order."""
    declared = {"o_orderstatus": "string", "o_orderdate": "timestamp_ntz", "o_orderkey": "bigint"}
    chosen = table(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    return enforce_contract(chosen, declared)


CONTRACT = "SELECT o_orderstatus, o_orderdate, o_orderkey FROM orders"


def suite(spark: SparkSession, folder: str) -> DataFrame:
    """Many checks of one table: the row checks share one pass."""
    checks = [
        q.not_null("event_id"),
        q.not_null("user_id").warn(),
        q.accepted_values("event_type", ["view", "click"]),
        q.accepted_range("cents", 0, 40000),
        q.expression_is_true("cents <> event_id"),
        q.length_between("event_type", 5, 6),
        q.greater_than("cents", "event_id", where="event_type = 'click'"),
        q.unique("event_id"),
        q.unique("user_id", where="event_type = 'error'"),
        q.relationships("user_id", table(spark, folder, "customer"), "c_custkey"),
        q.not_null_but_latest("cents", ["user_id"], "ts"),
    ]
    return q.run_checks(_events(spark, folder), checks)


SUITE = with_sql(
    _EVENTS,
    """counts AS (
         SELECT count(*) FILTER (event_id IS NULL) AS a, count(*) FILTER (user_id IS NULL) AS b,
                count(*) FILTER (event_type NOT IN ('view', 'click')) AS c,
                count(*) FILTER (cents < 0 OR cents > 40000) AS d, count(*) FILTER (cents = event_id) AS e,
                count(*) FILTER (length(event_type) NOT IN (5, 6)) AS f,
                count(*) FILTER (event_type = 'click' AND cents <= event_id) AS g
         FROM facts)""",
    """SELECT 'not_null(event_id)' AS "check", 'error' AS severity, a AS failures FROM counts
       UNION ALL SELECT 'not_null(user_id)', 'warn', b FROM counts
       UNION ALL SELECT 'accepted_values(event_type)', 'error', c FROM counts
       UNION ALL SELECT 'accepted_range(cents)', 'error', d FROM counts
       UNION ALL SELECT 'is_true(cents <> event_id)', 'error', e FROM counts
       UNION ALL SELECT 'length(event_type)', 'error', f FROM counts
       UNION ALL SELECT 'cents > event_id where event_type = ''click''', 'error', g FROM counts
       UNION ALL SELECT 'unique(event_id)', 'error',
         (SELECT count(*) FROM (SELECT event_id FROM facts GROUP BY 1 HAVING count(*) > 1) AS twice)
       UNION ALL SELECT 'unique(user_id) where event_type = ''error''', 'error',
         (SELECT count(*) FROM (SELECT user_id FROM facts WHERE event_type = 'error' AND user_id IS NOT NULL
                                GROUP BY 1 HAVING count(*) > 1) AS twice)
       UNION ALL SELECT 'relationships(user_id -> c_custkey)', 'error',
         (SELECT count(*) FROM facts WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT c_custkey FROM customer))
       UNION ALL SELECT 'not_null_but_latest(cents)', 'error',
         (SELECT count(*) - count(DISTINCT coalesce(user_id, -1)) FROM facts WHERE cents IS NULL)""",
)


ENTRIES = {
    "dq_not_null": Entry(not_null, NOT_NULL),
    "dq_unique": Entry(unique, UNIQUE),
    "dq_unique_combination": Entry(unique_combination, UNIQUE_COMBINATION),
    "dq_accepted_values": Entry(accepted_values, ACCEPTED_VALUES),
    "dq_accepted_range": Entry(accepted_range, ACCEPTED_RANGE),
    "dq_accepted_range_open": Entry(accepted_range_open, ACCEPTED_RANGE_OPEN),
    "dq_relationships": Entry(relationships, RELATIONSHIPS),
    "dq_expression_is_true": Entry(expression_is_true, EXPRESSION_IS_TRUE),
    "dq_length": Entry(lengths, LENGTHS),
    "dq_length_equals": Entry(length_equals, LENGTH_EQUALS),
    "dq_pair_greater": Entry(pair_greater, PAIR_GREATER),
    "dq_array_relationships": Entry(list_relationships, LIST_RELATIONSHIPS),
    "dq_min_array_length": Entry(min_list_length, MIN_LIST_LENGTH),
    "dq_equal_counts": Entry(equal_counts, EQUAL_COUNTS),
    "dq_min_date_after": Entry(minimum_after, MINIMUM_AFTER),
    "dq_no_overlap": Entry(no_overlap, NO_OVERLAP),
    "dq_not_null_window": Entry(not_null_but_latest, NOT_NULL_BUT_LATEST),
    "dq_window_expression": Entry(scan_is_true, SCAN_IS_TRUE),
    "dq_no_future_elements": Entry(no_element_after, NO_ELEMENT_AFTER),
    "dq_contract": Entry(contract, CONTRACT),
    "dq_suite": Entry(suite, SUITE),
}
