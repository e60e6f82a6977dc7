"""The operators on the supplied tables, one query each, with production parameters.

``ENTRIES`` is what the driver's registry adds. ``sql`` is None where DuckDB cannot express the
operator; those are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import pii, secrets_scan
from touchline.llm.chunk_dedup import repeats
from touchline.llm.collocations import collocations
from touchline.llm.decontaminate import contamination
from touchline.llm.fixity import archive, audited, manifest
from touchline.llm.mixing import mixture
from touchline.llm.ngram_join import ngram_join
from touchline.llm.packing import pack
from touchline.llm.quality_rules import quality
from touchline.llm.token_store import index_of, stored
from touchline.llm.vector_dedup import vector_links
from touchline.llm.whitening import whitened
from touchline.llm.words import read, shipped

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality(read(spark, sf_dir, "documents"))
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return rows.select(*first, "posterior")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped(spark)
    return pack(read(spark, sf_dir, "documents"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped(spark)
    return ngram_join(read(spark, sf_dir, "documents")).drop("digest")


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped(spark)
    return index_of(stored(read(spark, sf_dir, "documents")))


def op3_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages that documents share, in each document that has them."""
    shipped(spark)
    rows = repeats(read(spark, sf_dir, "documents"))
    spare = F.array_join(F.transform("spare", lambda s: F.concat_ws(":", s[0], s[1])), ",")
    return rows.withColumn("spare", spare)


def op6_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped(spark)
    return vector_links(read(spark, sf_dir, "embeddings"))


def op7_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record of the pages' archive and what a replica holds in its place, and what only the replica holds.

    The replica is damaged in one record of 256 each, told by the first byte of its hash: 00 has a byte of the head
    changed, 01 a byte of the body's end, 02 is lost, 03 lacks its last byte, and 04 stands behind the file a second time.
    """
    shipped(spark)
    original = archive(read(spark, sf_dir, "pages"))
    listed = manifest(original)
    return audited(listed, damaged(original)).select("page_id", "start", "length", "sha256", "state", "intact")


def damaged(original: DataFrame) -> DataFrame:
    told = original.withColumn("told", F.substring(F.sha2("record", 256), 1, 2))
    # FF occurs nowhere in UTF-8
    head, tail = (f"overlay(record PLACING X'FF' FROM {place} FOR 1)" for place in ("40", "CAST(length - 4 AS int)"))
    record = F.when(F.col("told") == "00", F.expr(head)).when(F.col("told") == "01", F.expr(tail))
    record = record.when(F.col("told") == "03", F.expr("substring(record, 1, CAST(length - 1 AS int))")).otherwise(F.col("record"))
    kept = told.filter("told <> '02'").withColumns({"record": record, "length": F.octet_length(record).cast("long")})
    ends = original.groupBy("file").agg(F.max(F.col("offset") + F.col("length")).alias("end"))
    again = told.filter("told = '04'").join(ends, "file").withColumn("offset", F.col("end") + F.col("offset"))
    return kept.drop("told").unionByName(again.drop("told", "end"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = ["doc_id", "size", "source_size", "target", "taken"]
    return mixture(read(spark, sf_dir, "documents")).select(*first, "source", "times", "positions")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped(spark)
    rows = secrets_scan.secrets(read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets_scan.BASE))
    of_kind = [pii.count_of("spans", kind).alias(f"n_{kind}") for kind in secrets_scan.BASE]
    return rows.select("doc_id", *of_kind, F.sha2(pii.as_text(base), 256).alias("base_sha256"), pii.as_text(F.col("spans")).alias("spans"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.personal_data(read(spark, sf_dir, "documents"))
    of_kind = [pii.count_of("base", kind).alias(f"n_{kind}") for kind in pii.PATTERNS]
    return rows.select("doc_id", *of_kind, F.sha2(pii.as_text(F.col("base")), 256).alias("base_sha256"), pii.as_text(F.col("spans")).alias("spans"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped(spark)
    return whitened(read(spark, sf_dir, "embeddings"))


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    items = F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256")
    return rows.select("doc_id", "n_words", "n_hit", "n_items", items, "contaminated")


QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_token_store": op2_token_store,
    "op3_chunk_dedup": op3_chunk_dedup,
    "op4_packing": op4_packing,
    "op5_ngram_join": op5_ngram_join,
    "op6_vector_dedup": op6_vector_dedup,
    "op7_warc_fixity": op7_warc_fixity,
    "op8_mixing": op8_mixing,
    "op9_secrets": op9_secrets,
    "op10_pii": op10_pii,
    "op11_collocations": op11_collocations,
    "op12_whitening": op12_whitening,
    "op13_decontaminate": op13_decontaminate,
}

# every pair with a shared n-gram is compared; a text of fewer than five words is one n-gram
NGRAM_JOIN_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
g AS (
  SELECT DISTINCT doc_id, array_to_string(words[i : i + 4], ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS size FROM g GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 10 * common >= 8 * (x.size + y.size - common)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT doc_id, min(other) AS class_id,
  (SELECT count(*) FROM links WHERE links.a = reach.doc_id) AS n_links, doc_id = min(other) AS kept
FROM reach GROUP BY doc_id"""

VECTOR_DEDUP_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
u AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM v WHERE list_dot_product(e, e) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM u x JOIN u y ON x.label = y.label AND x.vec_id <> y.vec_id
  WHERE list_dot_product(x.e, y.e) / (x.norm * y.norm) >= 0.98),
reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = reach.vec_id) AS n_links,
  min(other) AS component_id, vec_id = min(other) AS kept
FROM reach GROUP BY vec_id"""

WARC_FIXITY_SQL = r"""
WITH r AS (
  SELECT page_id, 'WARC/1.1' || e || 'WARC-Type: resource' || e || 'WARC-Record-ID: <urn:sha256:' || sha256(b) || '>'
    || e || 'WARC-Date: 2000-01-01T00:00:00Z' || e || 'WARC-Target-URI: ' || u || e || 'Content-Type: text/html'
    || e || 'Content-Length: ' || strlen(b) || e || e || b || e || e AS record
  FROM (SELECT page_id, coalesce(url, '') AS u, coalesce(html, '') AS b, chr(13) || chr(10) AS e FROM pages))
SELECT page_id,
  CAST(coalesce(sum(strlen(record)) OVER (ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start,
  strlen(record) AS length, sha256(record) AS sha256,
  CASE left(sha256(record), 2) WHEN '00' THEN 'changed' WHEN '01' THEN 'changed' WHEN '02' THEN 'missing'
    WHEN '03' THEN 'resized' ELSE 'intact' END AS state,
  left(sha256(record), 2) NOT IN ('00', '01', '02', '03') AS intact
FROM r
UNION ALL
SELECT NULL, NULL, strlen(record), sha256(record), 'extra', false FROM r WHERE starts_with(sha256(record), '04')"""

# phrases of each length counted apart
COLLOCATIONS_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
f AS (
  SELECT lang, g AS words, len(g) AS k, array_to_string(g, ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w[i : i + k - 1] AS g FROM (
    SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) AS sizes(k) WHERE len(w) >= k))
  GROUP BY lang, g HAVING count(*) >= 30),
c AS (SELECT * FROM f WHERE k > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, cut, x.f AS l, y.f AS r, (CAST(2000000 AS HUGEINT) * c.f) // (x.f + y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c) AS c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[: cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[cut + 1 :], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_ AS (
  SELECT lang, array_to_string(words[i : i + size - 1], ' ') AS phrase, f FROM (
    SELECT lang, words, f, size, unnest(range(1, k - size + 2)) AS i
    FROM (SELECT *, unnest(range(2, k)) AS size FROM c))),
holders AS (SELECT lang, phrase, max(f) AS holder FROM inner_ GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM lowest LEFT JOIN holders USING (lang, phrase) JOIN totals USING (lang)
WHERE NOT coalesce(CAST(100 AS HUGEINT) * holder >= CAST(80 AS HUGEINT) * a, false)
QUALIFY rank <= 2000"""

# every window of an item looked up at every place of every document
DECONTAMINATE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
i AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[k : k + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS k FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
places AS (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM d, sizes WHERE len(w) >= size),
occ AS (
  SELECT r, k, win.size, win.item_id FROM places
  JOIN win ON win.size = places.size AND win.win = array_to_string(w[k : k + places.size - 1], ' ')),
hit AS (
  SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(k, k + size)) AS place FROM occ) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS sha
  FROM (SELECT DISTINCT r, item_id FROM occ) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(sha, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)"""

ORACLE_SQL: dict[str, str] = {
    "op5_ngram_join": NGRAM_JOIN_SQL,
    "op6_vector_dedup": VECTOR_DEDUP_SQL,
    "op7_warc_fixity": WARC_FIXITY_SQL,
    "op11_collocations": COLLOCATIONS_SQL,
    "op13_decontaminate": DECONTAMINATE_SQL,
}
