"""Dedup, corrections, batches, conditional aggregates, scalar and list expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry.register import Entry, table
from registry.staged import as_text
from touchline import functions as fn
from touchline.operators.batches import batches, nested_ids
from touchline.operators.dedup import any_row, distinct_rows, latest_row
from touchline.operators.overrides import apply_overrides, corrected
from touchline.sources.tables import preview


def latest_row_dedup(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return latest_row(events, ["user_id", "event_type"], "ts", ties=["event_id"])


LATEST_ROW_DEDUP = """
  FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1
"""


def any_row_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return any_row(table(spark, folder, "events").select("user_id", "event_id", "ts"), ["user_id"], ties=["event_id"])


ANY_ROW_DEDUP = """
  SELECT user_id, min(event_id) AS event_id, arg_min(ts, event_id) AS ts FROM events GROUP BY user_id
"""


def distinct_load(spark: SparkSession, folder: str) -> DataFrame:
    """Whole-row dedup, list column included."""
    lines = table(spark, folder, "lineitem")
    items = F.array("l_linestatus", "l_returnflag").alias("flags")
    return distinct_rows(lines.select("l_orderkey", "l_linenumber", items)).withColumn("flags", F.concat_ws(",", "flags"))


DISTINCT_LOAD = """
  SELECT l_orderkey, l_linenumber, l_linestatus || ',' || l_returnflag AS flags
  FROM lineitem GROUP BY ALL
"""


def overrides(spark: SparkSession, folder: str) -> DataFrame:
    """A short table of constants first, then a table of the data."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    fixed = customers.withColumn(
        "c_mktsegment", corrected("c_mktsegment", "c_mktsegment", {"HOUSEHOLD": "HOME", "MACHINERY": "ENGINES"})
    )
    nations = table(spark, folder, "nation").filter("n_regionkey = 1")
    named = fixed.withColumn("place", F.concat(F.lit("n"), F.col("c_nationkey").cast("string")))
    return apply_overrides(named, "c_nationkey", "place", nations, "n_nationkey", "n_name")


OVERRIDES = """
  SELECT c_custkey, c_nationkey,
         CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'HOME' WHEN 'MACHINERY' THEN 'ENGINES' ELSE c_mktsegment END
           AS c_mktsegment,
         coalesce(n_name, 'n' || c_nationkey) AS place
  FROM customer LEFT JOIN (FROM nation WHERE n_regionkey = 1) AS named ON n_nationkey = c_nationkey
"""


def id_batches(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    parts = lines.select(F.array(F.struct(F.col("l_partkey").alias("id"))).alias("squad"))
    return batches(nested_ids(parts, "squad", name="part_id"), "part_id", 100)


ID_BATCHES = """
  SELECT l_partkey AS part_id, (dense_rank() OVER (ORDER BY l_partkey) - 1) // 100 AS batch
  FROM lineitem GROUP BY l_partkey
"""


def conditional_counts(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    large = F.col("l_quantity") > 25
    return lines.groupBy("l_suppkey").agg(
        F.count("l_partkey").alias("lines"),
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
        F.sum(F.when(large, 3).when(F.col("l_quantity") == 25, 1).otherwise(0)).alias("points"),
        F.min("l_returnflag").alias("first_flag"),
        F.max("l_shipdate").alias("last_ship"),
        F.bool_or(large).alias("any_large"),
        F.max(F.concat("l_returnflag", "l_linestatus")).alias("last_flags"),
    )


CONDITIONAL_COUNTS = """
  SELECT l_suppkey, count(l_partkey) AS lines, count(*) FILTER (l_returnflag = 'R') AS returned,
         CAST(sum(CASE WHEN l_quantity > 25 THEN 3 WHEN l_quantity = 25 THEN 1 ELSE 0 END) AS BIGINT) AS points,
         min(l_returnflag) AS first_flag, max(l_shipdate) AS last_ship, bool_or(l_quantity > 25) AS any_large,
         max(l_returnflag || l_linestatus) AS last_flags
  FROM lineitem GROUP BY l_suppkey
"""


def global_counts(spark: SparkSession, folder: str) -> DataFrame:
    """One row for the whole table, kept only if the two counts differ."""
    events = table(spark, folder, "events")
    kinds = F.col("event_type")
    counts = events.agg(F.count_if(kinds == "view").alias("views"), F.count_if(kinds == "click").alias("clicks"))
    return counts.filter("views <> clicks")


GLOBAL_COUNTS = """
  SELECT count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'click') AS clicks
  FROM events HAVING views <> clicks
"""


def surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    priority = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    return orders.select(
        "o_orderkey",
        fn.surrogate_key("order", "o_orderkey").alias("order_id"),
        fn.surrogate_key("day", "o_orderdate", "o_custkey").alias("day_id"),
        fn.surrogate_key("day", "o_orderdate", "o_custkey", separator="|").alias("day_id_apart"),
        fn.surrogate_key("priority", priority).alias("priority_id"),
    )


SURROGATE_KEYS = """
  SELECT o_orderkey, 'order_' || md5(CAST(o_orderkey AS VARCHAR)) AS order_id,
         'day_' || md5(CAST(o_orderdate AS VARCHAR) || o_custkey) AS day_id,
         'day_' || md5(CAST(o_orderdate AS VARCHAR) || '|' || o_custkey) AS day_id_apart,
         'priority_' || md5(CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END) AS priority_id
  FROM orders
"""


def slugify(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", fn.slug("text").alias("slug"))


SLUGIFY = "SELECT doc_id, strip_accents(replace(lower(text), ' ', '_')) AS slug FROM documents"


def text_functions(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    known = F.when(F.col("page_id") % 3 != 0, F.col("url"))
    pieces = fn.split_text("url", "/")
    return pages.select(
        "page_id",
        fn.code_to_words(F.upper("url")).alias("words"),
        F.concat(F.lit("p "), known).alias("strict"),
        fn.join_present(F.lit("p "), known).alias("lenient"),
        fn.list_length(pieces).alias("pieces"),
        F.concat_ws("|", pieces).alias("joined"),
        fn.list_length(fn.split_text("html", "><")).alias("tags"),
    )


TEXT_FUNCTIONS = """
  SELECT page_id, replace(lower(upper(url)), '_', ' ') AS words,
         'p ' || CASE WHEN page_id % 3 <> 0 THEN url END AS strict,
         concat('p ', CASE WHEN page_id % 3 <> 0 THEN url END) AS lenient,
         len(string_split(url, '/')) AS pieces, replace(url, '/', '|') AS joined,
         len(string_split(html, '><')) AS tags
  FROM pages
"""


def date_functions(spark: SparkSession, folder: str) -> DataFrame:
    at = F.col("o_orderdate")
    month = F.when(F.col("o_orderkey") % 5 != 0, F.date_format(at, "yyyy-MM"))
    found = table(spark, folder, "orders").select(
        "o_orderkey",
        F.year(at).cast("bigint").alias("year"),
        F.month(at).cast("bigint").alias("month"),
        fn.week_number(at).cast("bigint").alias("week"),
        fn.day_of_week(at).cast("bigint").alias("weekday"),
        fn.week_start(at).alias("monday"),
        fn.week_end(at).alias("sunday"),
        fn.month_start(at).alias("month_start"),
        fn.month_text_to_date(month).alias("from_month"),
        fn.year_to_date((F.col("o_orderkey") % 130 + 1890).cast("double")).alias("founded"),
        (at + F.expr("INTERVAL 120 MINUTES")).alias("later"),
        (at - F.expr("INTERVAL 1 WEEK")).alias("week_before"),
        F.date_format(at, "yyyy-MM-dd").cast("date").alias("reread"),
    )
    return as_text(found)


DATE_FUNCTIONS = """
  SELECT o_orderkey, year(o_orderdate) AS year, month(o_orderdate) AS month, week(o_orderdate) AS week,
         dayofweek(o_orderdate) AS weekday,
         CAST(CAST(date_trunc('week', o_orderdate) AS DATE) AS VARCHAR) AS monday,
         CAST(CAST(date_trunc('week', o_orderdate) + INTERVAL 6 DAYS AS DATE) AS VARCHAR) AS sunday,
         CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month_start,
         CASE WHEN o_orderkey % 5 <> 0 THEN strftime(o_orderdate, '%Y-%m-01') END AS from_month,
         (o_orderkey % 130 + 1890) || '-01-01' AS founded, o_orderdate + INTERVAL 2 HOURS AS later,
         o_orderdate - INTERVAL 7 DAYS AS week_before, strftime(o_orderdate, '%Y-%m-%d') AS reread
  FROM orders
"""


def age_years(spark: SparkSession, folder: str) -> DataFrame:
    """Completed years from each order to a leap-year birthday, before and after it."""
    orders = table(spark, folder, "orders")
    days = [("feb_28", "2025-02-28"), ("feb_29", "2024-02-29"), ("dec_31", "1996-12-31")]
    return orders.select(
        "o_orderkey", *[fn.completed_years("o_orderdate", F.lit(day).cast("date")).alias(name) for name, day in days]
    )


AGE_YEARS = """
  SELECT o_orderkey, date_sub('year', CAST(o_orderdate AS DATE), DATE '2025-02-28') AS feb_28,
         date_sub('year', CAST(o_orderdate AS DATE), DATE '2024-02-29') AS feb_29,
         date_sub('year', CAST(o_orderdate AS DATE), DATE '1996-12-31') AS dec_31
  FROM orders
"""


def projection(spark: SparkSession, folder: str) -> DataFrame:
    """Star minus and plus columns, an alias used beside its definition, unknown kept apart from false."""
    parts = table(spark, folder, "part").drop("p_type", "p_retailprice")
    small = F.when(F.col("p_size") != 10, F.col("p_size") < 20)
    chosen = parts.withColumns({"small": small, "origin": F.lit("catalog")})
    # both sides unknown or not: the row goes if the condition is not known to be false
    kept = chosen.filter(~((F.col("p_size") % 2 == 0) & F.col("small")) & F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3"))
    return kept.selectExpr("*", "p_size + 1 AS next_size", "next_size * 2 AS twice")


PROJECTION = """
  SELECT * EXCLUDE (p_type, p_retailprice), CASE WHEN p_size <> 10 THEN p_size < 20 END AS small,
         'catalog' AS origin, p_size + 1 AS next_size, next_size * 2 AS twice
  FROM part
  WHERE NOT (p_size % 2 = 0 AND small) AND p_brand IN ('Brand#1', 'Brand#2', 'Brand#3')
"""


def pluck_ids(spark: SparkSession, folder: str) -> DataFrame:
    """A list of structs per order line, its ids, and NULL for the empty list."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    both = F.array(F.struct(F.col("l_partkey").alias("id")), F.struct(F.col("l_suppkey").alias("id")))
    chosen = F.when(F.col("l_linenumber") % 3 != 0, both).otherwise(F.slice(both, 1, 0))
    ids = fn.pluck(chosen, "id")
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.when(ids.isNotNull(), F.concat_ws(",", ids)).alias("ids"),
        fn.list_length(ids).alias("n"),
        fn.holds(ids, F.col("l_suppkey").cast("string")).alias("has_supplier"),
    )


PLUCK_IDS = """
  SELECT l_orderkey, l_linenumber, l_partkey,
         CASE WHEN l_linenumber % 3 <> 0 THEN l_partkey || ',' || l_suppkey END AS ids,
         CASE WHEN l_linenumber % 3 <> 0 THEN CAST(2 AS BIGINT) END AS n,
         CASE WHEN l_linenumber % 3 <> 0 THEN true END AS has_supplier
  FROM lineitem
"""


def array_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Lists opened beside the other columns, two in lockstep, and put together again in order."""
    vectors = table(spark, folder, "embeddings").withColumn(
        "pair", F.transform("embedding", lambda x, i: F.struct(i.alias("i"), F.round(x * F.lit(1000).cast("float")).cast("int").alias("x")))
    )
    opened = vectors.select("vec_id", "label", fn.list_length("embedding").alias("n"), F.explode("pair").alias("p"))
    rows = opened.select("vec_id", "label", "n", "p.i", "p.x")
    # a vector has as many elements as the model has dimensions, so the list stays short
    listed = F.sort_array(F.collect_list(F.when(F.col("x") > 100, F.struct("i", "x"))))
    return rows.groupBy("vec_id", "label", "n").agg(
        F.count_if(F.col("x") > 0).alias("positive"),
        F.max("x").alias("largest"),
        F.concat_ws(",", F.transform(listed, lambda p: p["x"].cast("string"))).alias("over_100"),
    )


ARRAY_CHECKS = """
  SELECT vec_id, label, n, count(*) FILTER (x > 0) AS positive, max(x) AS largest,
         coalesce(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i) FILTER (x > 100), '') AS over_100
  FROM (SELECT vec_id, label, len(embedding) AS n, unnest(range(len(embedding))) AS i,
               CAST(round(CAST(unnest(embedding) AS FLOAT) * 1000) AS INTEGER) AS x
        FROM embeddings) AS opened
  GROUP BY vec_id, label, n
"""


def sorted_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select("o_orderpriority", "o_orderstatus").distinct().orderBy(
        F.col("o_orderpriority").desc_nulls_last(), F.col("o_orderstatus").asc_nulls_last()
    )


SORTED_DISTINCT = "SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders ORDER BY 1 DESC, 2"


def preview_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The five newest events."""
    return preview(table(spark, folder, "events").orderBy(F.col("ts").desc(), "event_id"))


PREVIEW_ROWS = "FROM events ORDER BY ts DESC, event_id LIMIT 5"


ENTRIES = {
    "latest_row_dedup": Entry(latest_row_dedup, LATEST_ROW_DEDUP),
    "any_row_dedup": Entry(any_row_dedup, ANY_ROW_DEDUP),
    "distinct_load": Entry(distinct_load, DISTINCT_LOAD),
    "overrides": Entry(overrides, OVERRIDES),
    "id_batches": Entry(id_batches, ID_BATCHES),
    "conditional_counts": Entry(conditional_counts, CONDITIONAL_COUNTS),
    "global_counts": Entry(global_counts, GLOBAL_COUNTS),
    "surrogate_keys": Entry(surrogate_keys, SURROGATE_KEYS),
    "slugify": Entry(slugify, SLUGIFY),
    "text_functions": Entry(text_functions, TEXT_FUNCTIONS),
    "date_functions": Entry(date_functions, DATE_FUNCTIONS),
    "age_years": Entry(age_years, AGE_YEARS),
    "projection": Entry(projection, PROJECTION),
    "pluck_ids": Entry(pluck_ids, PLUCK_IDS),
    "array_checks": Entry(array_checks, ARRAY_CHECKS),
    "sorted_distinct": Entry(sorted_distinct, SORTED_DISTINCT),
    "preview": Entry(preview_rows, PREVIEW_ROWS),
}
