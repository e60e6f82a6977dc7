"""Personal data by bootstrapped contextual extraction.

*Base kinds* - email, ip, card, phone - have a form that can be told without context: a pattern
and a test of what it matched. They are the seeds. Around them the corpus itself tells more:

1. Every *mention*, a word with a digit or an ``@`` in it, is kept with its context, the two words before it. A word
   that is itself a mention stands there as a mark, and so does the beginning of the text.
2. The contexts of known identifiers are patterns. A pattern's confidence is the share of known
   identifiers among everything that follows it anywhere in the corpus, ordinary words included.
3. A mention's confidence is the chance that at least one of the patterns it was found with is right.
   Mentions above the threshold become known, bring in their other contexts, and so on until a round adds
   neither a pattern nor a mention. Scores only rise, so that comes.

The mentions of patterns that ended confident are reported as kind ``context``. Everything is
DataFrame functions; the corpus is read for the mentions, and once more to count what follows the
contexts that enough seeds share. Each round of scoring only touches mentions.

Places are code points, end exclusive. A NULL text is empty. Rows are told apart by a number of their own,
so repeated rows and NULL ids come out once each, as they went in.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.words import bit_set, bound, gaps_of, marked, matches_of, placed, written

# The forms of the base kinds. Possessive quantifiers and look-behinds only
# keep the search linear, they match what the plain forms match: a run of one class is entered at its
# beginning, or where the last match ended.
_LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
KINDS = (*PATTERNS, "context")

_BLANK = r"\x20\x09-\x0D"
MENTION = rf"[0-9@][^{_BLANK}]*+"
"""A mention from its first digit or ``@`` on; what the word has before that ends the gap before."""
AT_MENTION, AT_START = "\x01", "\x02"
"""What stands in a context for a mention and for the beginning of the text; no word holds such a character alone."""


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _is_byte(part: Column) -> Column:
    short = F.regexp_replace(part, "^0+", "")
    return (F.length(short) <= 2) | ((F.length(short) == 3) & (short <= "255"))


HOLDS = {
    "email": lambda value: F.lit(True),
    "ip": lambda value: F.forall(F.split(value, r"\."), _is_byte),
    "card": lambda value: F.length(_digits(value)).between(13, 19) & F.call_function("luhn_check", _digits(value)),
    "phone": lambda value: F.length(_digits(value)).between(9, 15),
}


def found(text: Column, kind: str) -> Column:
    """``array<struct<start, stop, value, gap>>`` of a base kind in a text, failing matches dropped."""
    places = placed(gaps_of(text, PATTERNS[kind]), matches_of(text, PATTERNS[kind]))
    kept = F.filter(places, lambda place: HOLDS[kind](place["value"]))
    needed = F.lit(True) if NEEDS[kind] is None else F.contains(text, F.lit(NEEDS[kind]))
    if kind != "email":
        needed = needed & text.rlike("[0-9]")
    return F.when(needed, kept).otherwise(F.expr(_NONE))


_NONE = "array() :: array<struct<start: bigint, stop: bigint, value: string, gap: string>>"


@dataclass(frozen=True)
class Settings:
    support: int = 5
    """Different known identifiers a context has to be seen with before it is a pattern."""

    confidence: float = 0.5
    """Share of known identifiers among all that follows a pattern."""

    accept: float = 0.5
    """Confidence above which a mention becomes known."""


def context_words(text: Column) -> Column:
    """Two marks for the beginning, then the words of a text in lower case, mentions as marks."""
    words = F.array_remove(F.split(F.lower(text), rf"[{_BLANK}]+"), "")
    marked = F.transform(words, lambda word: F.when(word.rlike("[0-9@]"), AT_MENTION).otherwise(word))
    return F.concat(F.array(F.lit(AT_START), F.lit(AT_START)), marked)


def mention_words(text: Column) -> Column:
    """``array<struct<start, value>>``: the words with a digit or an ``@``, in order.

    A pattern that looks back at each character for the beginning of its word takes 17 times as long.
    """

    def whole(place: Column) -> Column:
        lead = F.substring_index(F.translate(place["gap"], "\t\n\x0b\x0c\r", "     "), " ", -1)
        return bound(lead, lambda x: F.struct((place["start"] - F.length(x)).alias("start"), F.concat(x, place["value"]).alias("value")))

    return F.transform(placed(gaps_of(text, MENTION), matches_of(text, MENTION)), whole)


def _context(words: Column, i: Column) -> Column:
    """The context of the word with number ``i``, counted without the two marks."""
    return F.concat(F.get(words, i), F.lit(" "), F.get(words, i + 1))


def with_mentions(docs: DataFrame, text: str) -> DataFrame:
    """Each row with its base spans, ``<kind>s``, and its ``mentions``: ``start, stop, value, before``.

    A mention leaves out punctuation around the identifier; ``before`` is its context.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    spans = {f"__{kind}": F.transform(found(F.col("__text"), kind), lambda x: x.dropFields("gap")) for kind in PATTERNS}

    def mention(place: Column, before: Column) -> Column:
        lead = F.regexp_extract(place["value"], r"^[\"'(\[{<,;:]*", 0)
        core = F.regexp_replace(place["value"], r"^[\"'(\[{<,;:]+|[\"')\]}>,;:.!?]+$", "")
        start = place["start"] + F.length(lead)
        return F.struct(start.alias("start"), (start + F.length(core)).alias("stop"), core.alias("value"), before.alias("before"))

    def contexts(words: Column) -> Column:
        """Those of the mentions, in order."""
        places = F.filter(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.get(words, i + 2) == AT_MENTION)
        return F.transform(places, lambda i: _context(words, i))

    some = F.col("__text").rlike("[0-9@]")
    where = F.when(some, mention_words(F.col("__text"))).otherwise(F.expr("array() :: array<struct<start: bigint, value: string>>"))
    before = F.when(some, bound(context_words(F.col("__text")), contexts)).otherwise(F.expr("array() :: array<string>"))
    return docs.withColumn("__text", whole).withColumns(spans | {"__places": where, "__before": before}).withColumn(
        "__mentions", F.filter(F.zip_with("__places", "__before", mention), lambda m: m["value"] != "")
    ).drop("__text", "__places", "__before")


def known_contexts(rows: DataFrame, docs: DataFrame, text: str, settings: Settings) -> DataFrame:
    """``(before, value)`` of the mentions that patterns found: rounds of scoring patterns and mentions.

    ``rows`` come from :func:`with_mentions` and have been written down.
    """
    base = F.flatten(F.array(*[F.col(f"__{kind}") for kind in PATTERNS]))
    mentions = rows.select(
        F.explode(
            F.transform("__mentions", lambda m: F.struct(m["value"].alias("value"), m["before"].alias("before"), F.exists(base, lambda b: (b["start"] < m["stop"]) & (m["start"] < b["stop"])).alias("seed")))
        ).alias("m")
    ).select("m.*")
    graph = written(
        mentions.groupBy("before", "value").agg(F.max("seed").alias("seed"), F.count(F.lit(1)).alias("times")), "mentions"
    )
    # contexts that enough different mentions share; only these can ever become patterns
    frequent = written(
        graph.groupBy("before").agg(F.count(F.lit(1)).alias("values"), F.sum("times").alias("mentioned")).filter(F.col("values") >= settings.support),
        "contexts",
    )
    if frequent.isEmpty():
        return graph.select("before", "value").limit(0)
    followers = written(frequent.join(_followers(docs, text, frequent), "before", "left"), "followers")
    edges = written(graph.join(followers, "before"), "graph")

    known = edges.groupBy("value").agg(F.max("seed").cast("double").alias("score"))
    size = None
    while True:
        scored = edges.join(known, "value")
        of_pattern = scored.groupBy("before").agg(
            F.sum(F.col("times") * F.col("score")).alias("right"),
            F.first("all").alias("all"),
            F.count(F.when(F.col("score") >= settings.accept, 1)).alias("support"),
        )
        patterns = written(
            of_pattern.select("before", "support", (F.col("right") / F.greatest("all", "right")).alias("confidence")).filter(
                (F.col("support") >= settings.support) & (F.col("confidence") >= settings.confidence)
            ),
            "patterns",
        )
        # chance that at least one pattern a mention was found with is right
        wrong = F.sum(F.log1p(-F.least(F.col("confidence"), F.lit(0.999999))))
        found_by = edges.join(patterns, "before").groupBy("value").agg((1 - F.exp(wrong)).alias("by_pattern"))
        known = written(
            edges.groupBy("value").agg(F.max("seed").alias("seed")).join(found_by, "value", "left").select(
                "value",
                F.when(F.col("seed"), 1.0)
                .when(F.col("by_pattern") >= settings.accept, F.col("by_pattern"))
                .otherwise(0.0)
                .alias("score"),
            ),
            "known",
        )
        before, size = size, (patterns.count(), known.filter(F.col("score") > 0).count())
        if size == before:
            break
    unseen = edges.filter(~F.col("seed")).join(known.filter(F.col("score") > 0), "value").join(patterns, "before")
    return unseen.select("before", "value")


def _followers(docs: DataFrame, text: str, frequent: DataFrame) -> DataFrame:
    """How often each context is followed by any word at all, a mention or not.

    Word pairs that are no context are dropped where they are made, by the bits of their hash, and
    the others are counted before they are joined: what is shuffled is a count for each context and
    task, not the pairs. Pairs that share a context's bits by chance fall out in the join.
    """
    pairs = docs.select(context_words(F.coalesce(F.col(text), F.lit(""))).alias("w")).select(
        F.explode(F.transform(F.slice("w", F.lit(1), F.size("w") - 2), lambda first, i: _context(F.col("w"), i))).alias("before")
    )
    hashes = bit_set(frequent.select(F.xxhash64("before").alias("hash")), "hash")
    counted = pairs.filter(marked(hashes, F.xxhash64("before"))).groupBy("before").agg(F.count(F.lit(1)).alias("all"))
    # an inner join, since a semi join would be pushed below the counting
    return counted.join(frequent.select("before"), "before")


def _named(kind: str):
    return lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"))


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def personal_data(docs: DataFrame, text: str = "text", settings: Settings = Settings(), carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns and ``spans``: ``array<struct<kind, start, stop>>`` by kind as listed, then start.

    One row for each row of ``docs``.
    """
    slim = docs.select(*carry, F.col(text).alias("__source"))
    rows = written(
        with_mentions(slim, "__source").drop("__source").withColumn("__row", F.monotonically_increasing_id()), "personal"
    )
    unseen = known_contexts(rows, docs.select(F.col(text).alias("__source")), "__source", settings)
    unseen = written(unseen.distinct(), "unseen")
    base = F.concat(*[F.transform(f"__{kind}", _named(kind)) for kind in PATTERNS])
    rows = rows.withColumn("base", base)
    if unseen.isEmpty():
        more = rows.withColumn("more", F.expr("array() :: array<struct<kind: string, start: bigint, stop: bigint>>"))
    else:
        each = rows.select("__row", F.explode("__mentions").alias("m")).select("__row", "m.*")
        hits = each.join(unseen, ["before", "value"]).groupBy("__row").agg(
            F.sort_array(F.collect_set(F.struct(F.lit("context").alias("kind"), "start", "stop"))).alias("more")
        )
        more = rows.join(written(hits, "context"), "__row", "left").withColumn(
            "more", F.coalesce("more", F.expr("array() :: array<struct<kind: string, start: bigint, stop: bigint>>"))
        )
        # what a base span already covers is not reported again
        more = more.withColumn(
            "more",
            F.filter("more", lambda m: ~F.exists("base", lambda b: (b["start"] < m["stop"]) & (m["start"] < b["stop"]))),
        )
    return more.select(*carry, "base", F.concat("base", "more").alias("spans"))


def as_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas, in the given order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans are joined under the first one's kind."""
    order = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["stop"]).alias("back"), s["kind"].alias("kind"))))
    pieces = F.aggregate(
        order,
        F.struct(F.lit(0).cast("long").alias("at"), F.expr("array() :: array<string>").alias("out")),
        lambda a, s: F.when(
            s["start"] >= a["at"],
            F.struct(
                (-s["back"]).alias("at"),
                F.concat(
                    a["out"],
                    F.array(
                        F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")),
                        F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")),
                    ),
                ).alias("out"),
            ),
        ).otherwise(F.struct(F.greatest(a["at"], -s["back"]).alias("at"), a["out"].alias("out"))),
        lambda a: F.concat(F.array_join(a["out"], ""), F.substring(text, (a["at"] + 1).cast("int"), F.length(text))),
    )
    return F.when(F.size(spans) > 0, pieces).otherwise(text)


def redacted(docs: DataFrame, text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``docs`` with personal data masked in the text column; all rows and columns stay."""
    names = docs.columns
    plain = docs.toDF(*[f"__d{i}" for i in range(len(names))])
    source = f"__d{names.index(text)}"
    result = personal_data(plain, source, settings, tuple(plain.columns))
    return result.select(
        *[(masked(F.col(source), F.col("spans")) if f"__d{i}" == source else F.col(f"__d{i}")).alias(name) for i, name in enumerate(names)]
    )
