"""Phrase collocations by marginalising counts of the longest windows.

1. *Lead windows.* Every word of a piece of text, with the words that follow it, is one window of ``longest``
   words; where the piece ends earlier the rest is padded with NULL. Equal windows are counted once.
2. *Marginalisation.* A phrase of k words begins exactly the windows whose first k words it is, so Spark's
   ROLLUP over the window's columns sums the counts of all shorter phrases from those of the longest:
   no text is read again for them and no n-grams of other lengths are made.
3. *Score.* Each way of cutting a candidate in two gives ``2000000 a / (l + r)``, rounded down; the lowest counts.
   Candidates that mostly occur inside a longer one go, the rest is ranked per language.

A phrase that occurs ``least`` times has only neighbouring pairs that do so too. So before the windows are
counted, they are padded from the first pair on that is rarer, which turns almost all of them into a few
short ones. These pairs are one count of hashes; what the windows are cut by is a set of bits of bounded size,
which may let a rare pair pass and never stops a frequent one. The counts of frequent phrases are the same
with and without the cut, at any size of the corpus.

Numbers are exact: counts are longs, and products are decimals of 38 digits, as they may pass 64 bits. Words
are compared by their bytes. A NULL text is empty, a NULL language is ``und``; repeated rows and NULL
numbers count like any others, other columns are ignored, and an empty table gives no phrases. A language
with few candidates returns them all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchline.llm.words import lower_ascii, marked, sized_bit_set, written

LEAST = 30
LONGEST = 4
BEST = 2_000
MOST_BITS = 1 << 27
"""Bits in the set of frequent pairs at most: 16 MB."""

_BREAKS = r"[.,;:!?\x0A-\x0D]"
_BLANKS = r"[\x20\x09]+"


def _wide(value: Column) -> Column:
    return value.cast("decimal(20,0)")


def window_columns(longest: int) -> list[str]:
    return [f"w{k}" for k in range(1, longest + 1)]


def windows(docs: DataFrame, text: str, lang: str, longest: int) -> DataFrame:
    """``lang, w1 .. w<longest>``: each word with those that follow it in its piece, NULL beyond the end."""
    pieces = F.split(F.coalesce(lower_ascii(F.col(text)), F.lit("")), _BREAKS)
    # one list for all pieces, a NULL after each of them
    words = F.flatten(F.transform(pieces, lambda piece: F.array_append(F.array_remove(F.split(piece, _BLANKS), ""), F.lit(None).cast("string"))))
    lists = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), words.alias("__words"))
    names = window_columns(longest)
    ahead = [F.slice("__words", F.lit(k + 1), F.size("__words")).alias(name) for k, name in enumerate(names)]
    rows = lists.select("lang", F.inline(F.arrays_zip(*ahead))).filter("w1 IS NOT NULL")
    return _padded(rows, names, [F.col(name).isNotNull() for name in names[1:]])


def _padded(rows: DataFrame, names: Sequence[str], goes_on: Sequence[Column]) -> DataFrame:
    """The windows as far as every condition on a word and the one before it holds."""
    kept, out = F.lit(True), [F.col(names[0])]
    for name, on in zip(names[1:], goes_on, strict=True):
        kept = kept & F.coalesce(on, F.lit(False))
        out.append(F.when(kept, F.col(name)).alias(name))
    return rows.select("lang", *out)


def _pair(first: str, second: str) -> Column:
    return F.xxhash64("lang", first, second)


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """``lang, words, n_words, f``: phrases of up to ``longest`` words that occur ``least`` times; with 0 words, all occurrences."""
    names = window_columns(longest)
    rows = windows(docs, text, lang, longest)
    pairs = windows(docs, text, lang, 2).filter("w2 IS NOT NULL").groupBy(_pair("w1", "w2").alias("pair")).agg(F.count(F.lit(1)).alias("n"))
    frequent = written(pairs.filter(F.col("n") >= least).select("pair"), "pairs")
    bits, size = sized_bit_set(frequent, "pair", MOST_BITS)
    cut = _padded(rows, names, [marked(bits, _pair(a, b), size) & F.col(b).isNotNull() for a, b in zip(names, names[1:], strict=False)])
    counted = written(cut.groupBy("lang", *names).agg(F.count(F.lit(1)).alias("n")), "windows")
    # a full window is counted as it stands, all that is shorter is summed
    *prefix, last = names
    full = counted.filter(F.col(last).isNotNull() & (F.col("n") >= least)).select("lang", F.array(*names).alias("words"), F.lit(longest).alias("n_words"), F.col("n").alias("f"))
    summed = counted.rollup("lang", *prefix).agg(F.sum("n").alias("f"), F.grouping_id().alias("level"))
    # grouping_id sets a bit for each column summed over, the last ones first; padding is no phrase of that length
    phrases = summed.filter(F.col("level") < (1 << len(prefix))).withColumn("n_words", (F.lit(len(prefix)) - F.bit_count("level")).cast("int"))
    words = F.slice(F.array(*prefix), F.lit(1), F.col("n_words"))
    whole = (F.col("n_words") == 0) | ((F.col("f") >= least) & F.get(F.array(*prefix), F.col("n_words") - 1).isNotNull())
    return full.unionByName(phrases.filter(whole).select("lang", words.alias("words"), "n_words", "f"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, best: int = BEST) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best phrases of 2 to ``longest`` words."""
    known = written(phrase_counts(docs, text, lang, least, longest).withColumn("phrase", F.array_join("words", " ")), "phrases")
    totals = known.filter("n_words = 0").select("lang", F.col("f").alias("n"))
    counts = known.filter("n_words > 0")
    candidates = counts.filter("n_words > 1").select("lang", "phrase", "words", "n_words", F.col("f").alias("a"))

    # both parts of a frequent phrase are frequent, so they are all known
    def part(begin: Column, length: Column) -> Column:
        return F.array_join(F.slice("words", begin, length), " ")

    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("head"), part(F.col("k") + 1, F.col("n_words") - F.col("k")).alias("tail"))
    left = counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    cuts = cuts.join(left, ["lang", "head"]).join(right, ["lang", "tail"])
    score = F.call_function("div", _wide(F.lit(2_000_000)) * _wide(F.col("a")), _wide(F.col("l")) + _wide(F.col("r")))
    lowest = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    # what stands inside a longer candidate, and how often the most frequent of those occurs
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("n_words") - 1),
            lambda size: F.transform(F.sequence(F.lit(1), F.col("n_words") - size + 1), lambda at: F.array_join(F.slice("words", at, size), " ")),
        )
    )
    inside = candidates.filter("n_words > 2").select("lang", F.explode(inner).alias("phrase"), "a")
    holders = inside.groupBy("lang", "phrase").agg(F.max("a").alias("holder"))
    covered = _wide(F.lit(100)) * _wide(F.col("holder")) >= _wide(F.lit(80)) * _wide(F.col("a"))
    left_over = lowest.join(holders, ["lang", "phrase"], "left").filter(~F.coalesce(covered, F.lit(False)))

    order = W.partitionBy("lang").orderBy(F.col("cut.score").desc(), F.col("a").desc(), "phrase")
    ranked = left_over.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
