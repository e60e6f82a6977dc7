"""Benchmark decontamination as a prefix-filtered set join of word shingles.

Every *window* of a benchmark item - ``width`` consecutive words, or all words of a shorter item - is a set of
*shingles* of ``shingle`` words at fixed distances. A document holds the window if it holds the whole
set at these distances.

1. *Order by rarity.* One pass over the documents counts the items' shingles in them.
2. *Prefix.* A document that holds all shingles of a window holds its rarest one. So the necessary prefix
   of a set is its first shingle in order of rarity, and only these are looked for in the second pass:
   neighbouring windows mostly share them, and what is common in the corpus is hardly ever one.
3. *Bounds.* A hit at a position tells where the window would begin; it has to begin and to end
   within the document.
4. *Verification.* The words around a hit, kept beside it, are compared with the window word by word.

Both passes drop shingles of no interest where they are made, by the bits of their hashes, in a set
of fixed size. So texts are never shuffled, nor are their shingles: only counts, and the few hits.

Words are runs of letters A to Z in either case, digits and characters beyond ASCII. A text that is NULL, empty or
without words has no words and hits nothing; an item without words has no window. Rows of an item with the
same number are one item with the windows of all of them; an item without number counts as one more and
is named by the empty string. Rows of documents come out once each, whatever their numbers. Empty tables
give an empty result or untouched documents. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchline.llm.words import bit_set, lower_ascii, marked, written

WIDTH = 10
SHINGLE = 4

_OUTSIDE = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def item_words(text: Column) -> Column:
    """The words of a text in order; none for NULL."""
    return F.array_remove(F.split(F.coalesce(lower_ascii(text), F.lit("")), _OUTSIDE), "")


def _shingles(words: Column, width: int) -> Column:
    """The hash of the ``width`` words that begin at each place, as far as there are so many."""
    starts = F.slice(words, F.lit(1), F.greatest(F.size(words) - (width - 1), F.lit(0)))
    return F.transform(starts, lambda word, i: F.xxhash64(word, *[F.get(words, i + k) for k in range(1, width)]))


def windows_of(items: DataFrame, item_id: str, text: str, width: int, shingle: int) -> DataFrame:
    """``window, item_id, words, size, span``: distinct windows of each item; ``span`` is the width of their shingles."""
    words = items.select(F.col(item_id).cast("string").alias("item_id"), item_words(F.col(text)).alias("__words")).filter(F.size("__words") > 0)
    size = F.least(F.size("__words"), F.lit(width))
    starts = F.sequence(F.lit(1), F.size("__words") - size + 1)
    each = words.select("item_id", F.explode(F.transform(starts, lambda at: F.slice(F.col("__words"), at, size))).alias("words"))
    return each.distinct().select(
        "item_id", "words", F.array_join("words", " ").alias("window"), F.size("words").alias("size"), F.least(F.size("words"), F.lit(shingle)).alias("span")
    )


def _rarest(windows: DataFrame, texts: DataFrame, spans: list[int]) -> DataFrame:
    """``window, words, size, span, anchor, shift``: each distinct window with its rarest shingle and that one's place."""
    each = None
    for span in spans:
        own = windows.filter(F.col("span") == span).select(
            "window", "words", "size", "span", F.posexplode(_shingles(F.col("words"), span)).alias("shift", "anchor")
        )
        each = own if each is None else each.unionByName(own)
    each = written(each.dropDuplicates(["window", "shift"]), "shingles")
    counts = None
    for span in spans:
        wanted = each.filter(F.col("span") == span).select("anchor").distinct()
        bits = bit_set(wanted, "anchor")
        met = texts.select(F.explode(_shingles(F.col("words"), span)).alias("anchor")).filter(marked(bits, F.col("anchor")))
        counted = met.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).withColumn("span", F.lit(span))
        counts = counted if counts is None else counts.unionByName(counted)
    counts = written(counts, "rarity")
    order = F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("anchor"), F.col("shift"))
    return (
        each.join(counts, ["span", "anchor"], "left")
        .groupBy("window")
        .agg(F.min(order).alias("first"), F.first("words").alias("words"), F.first("size").alias("size"), F.first("span").alias("span"))
        .select("window", "words", "size", "span", "first.anchor", "first.shift")
    )


def _hits(words: Column, span: int, width: int, bits) -> Column:
    """``array<struct<span, anchor, at, skip, around>>``: places whose shingle may be an anchor, and the words around."""
    around = width - span

    def hit(i: Column, anchor: Column) -> Column:
        low = F.greatest(i - around, F.lit(0))
        return F.struct(
            F.lit(span).alias("span"), anchor.alias("anchor"), i.alias("at"), (i - low).alias("skip"), F.slice(words, low + 1, F.lit(2 * width - span)).alias("around")
        )

    placed = F.transform(_shingles(words, span), lambda anchor, i: F.struct(anchor.alias("anchor"), i.alias("at")))
    return F.transform(F.filter(placed, lambda p: marked(bits, p["anchor"])), lambda p: hit(p["at"], p["anchor"]))


def contamination(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    width: int = WIDTH,
    shingle: int = SHINGLE,
) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_words, n_hit, n_items, item_ids, contaminated``.

    ``n_hit`` is the number of words inside occurrences of windows, ``item_ids`` the items these windows are
    from, as strings in order.
    """
    windows = written(windows_of(items, item_id, item_text, width, shingle), "windows")
    # at most as many as there are widths of shingles
    spans = sorted(row["span"] for row in windows.select("span").distinct().collect())
    texts = docs.select(F.col(doc_id).alias("doc_id"), item_words(F.col(text)).alias("words"))
    none = F.lit(0).cast("long")
    if not spans:
        return texts.select(
            "doc_id", F.size("words").cast("long").alias("n_words"), none.alias("n_hit"), none.alias("n_items"), F.expr("array() :: array<string>").alias("item_ids"), F.lit(False).alias("contaminated")
        )
    anchors = written(_rarest(windows, texts, spans), "anchors")
    hits = F.concat(*[_hits(F.col("words"), span, width, bit_set(anchors.filter(F.col("span") == span), "anchor")) for span in spans])
    rows = texts.select("doc_id", F.size("words").cast("long").alias("n_words"), hits.alias("hits"), F.monotonically_increasing_id().alias("row"))
    rows = written(rows, "hits")

    found = rows.select("row", "n_words", F.explode("hits").alias("h")).select("row", "n_words", "h.*").join(anchors, ["span", "anchor"])
    start = F.col("at") - F.col("shift")
    inside = (start >= 0) & (start + F.col("size") <= F.col("n_words"))
    same = F.slice("around", F.col("skip") - F.col("shift") + 1, F.col("size")) == F.col("words")
    found = found.filter(inside & F.when(inside, same)).select("row", "window", start.cast("long").alias("start"), (start + F.col("size")).cast("long").alias("stop"))
    found = written(found, "occurrences")

    # words inside: each occurrence adds what lies beyond all that began before it
    before = W.partitionBy("row").orderBy("start", "stop").rowsBetween(W.unboundedPreceding, -1)
    fresh = F.col("stop") - F.greatest("start", F.coalesce(F.max("stop").over(before), F.col("start")))
    covered = found.select("row", "start", "stop").distinct().withColumn("fresh", F.greatest(fresh, F.lit(0)))
    n_hit = covered.groupBy("row").agg(F.sum("fresh").alias("n_hit"))
    named = windows.select("window", F.coalesce("item_id", F.lit("")).alias("item_id"))
    of_items = found.select("row", "window").distinct().join(named, "window").groupBy("row").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    dirty = written(n_hit.join(of_items, "row"), "contaminated")
    return rows.select("row", "doc_id", "n_words").join(dirty, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", none).alias("n_hit"),
        F.coalesce(F.size("item_ids").cast("long"), none).alias("n_items"),
        F.coalesce("item_ids", F.expr("array() :: array<string>")).alias("item_ids"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold a window of an item; all columns stay.

    A document without a number is told by its text alone, like one that repeats another's number.
    """
    names = docs.columns
    plain = docs.toDF(*[f"__d{i}" for i in range(len(names))])
    key = F.struct(*[F.col(f"__d{names.index(name)}") for name in (doc_id, text)])
    keyed = plain.withColumn("__key", F.sha2(F.to_json(key, {"ignoreNullFields": "false"}), 256))
    result = contamination(keyed, items, "__key", f"__d{names.index(text)}", item_id, item_text, **options)
    dirty = written(result.filter("contaminated").select(F.col("doc_id").alias("__dirty")).distinct(), "dirty")
    left = keyed.join(dirty, F.col("__key") == F.col("__dirty"), "left_anti")
    return left.select(*[F.col(f"__d{i}").alias(name) for i, name in enumerate(names)])
