"""Quality by weak supervision: rules vote or abstain, their accuracies are estimated without labels.

Each rule votes *keep*, votes *reject* or abstains on a document. A latent class model says how often
each rule rejects among good documents and among each kind of bad ones; expectation maximisation
estimates these rates from the votes only, and the posterior probability of being good replaces "all
rules must pass".

The model sees a document only through its votes, so the estimation runs on the histogram of vote
patterns, which has at most ``3 ** len(RULES)`` rows whatever the size of the corpus. One pass over
the texts makes the histogram, each step of the estimation is one aggregate over it, and the
posterior is an ordinary column expression with the estimated rates in it: no shuffle of documents.

Defined cases: a NULL or empty text has no words and fails the base rule; NULLs in other columns do
not matter; repeated rows are judged each by itself and come out equal; an empty table gives an
empty result; a text of any length is one row whose work is linear but for one sort of its windows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.words import bound, words_of, written

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20

# Frequent function words of the languages the corpus is expected to hold.
FUNCTION_WORDS = (
    "the of and to in is that it for was on are as with be by at this or an "
    "de la le les et des en un une que qui dans est pour par du au sur avec "
    "el los las del y se con para una no su al lo como "
    "der die das und ist von zu mit den dem ein eine nicht auf für im"
).split()

KEEP, ABSTAIN, REJECT = 1, 0, -1


def features(df: DataFrame, text: str = "text", prefix: str = "__q_") -> DataFrame:
    """``df`` with the counts the rules look at, each one named ``prefix`` + name."""
    words, lines, hashes, grams = (f"{prefix}{name}" for name in ("words", "lines", "hashes", "grams"))
    whole = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumns(
        {
            words: words_of(F.col(text)),
            lines: F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
        }
    )
    df = df.withColumn(hashes, F.transform(words, lambda word: F.xxhash64(word)))
    # the hash of a window stands for its words: 64 bits, compared within one text only
    df = df.withColumn(
        grams,
        F.when(
            F.size(hashes) >= WINDOW,
            F.transform(
                F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(0))),
                lambda first, i: F.xxhash64(first, *[F.get(F.col(hashes), i + k) for k in range(1, WINDOW)]),
            ),
        ).otherwise(F.expr("array() :: array<bigint>")),
    )
    counts = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.length(F.regexp_replace(whole, f"[^{SYMBOLS}]+", "")),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": _repeated_words(F.col(grams)),
        "n_distinct": F.size(F.array_distinct(hashes)),
        "n_capitals": F.length(F.regexp_replace(whole, r"\P{Lu}+", "")),
        "n_exclaims": F.length(F.regexp_replace(whole, "[^!]+", "")),
        "n_stutters": F.size(F.filter(hashes, lambda h, i: h == F.get(F.col(hashes), i - 1))),
        "n_function_words": F.size(F.array_intersect(words, F.array(*[F.lit(w) for w in FUNCTION_WORDS]))),
    }
    return df.withColumns({f"{prefix}{name}": count.cast("long") for name, count in counts.items()}).drop(
        words, lines, hashes, grams
    )


def _repeated_words(grams: Column) -> Column:
    """Words inside windows that occur twice or more, the first occurrence included."""
    marked = F.sort_array(F.transform(grams, lambda gram, i: F.struct(gram.alias("gram"), i.alias("at"))))

    def starts(rows):
        again = F.filter(
            rows,
            lambda row, i: (F.get(rows, i - 1)["gram"] == row["gram"])
            | F.coalesce(F.get(rows, i + 1)["gram"] == row["gram"], F.lit(False)),
        )
        return F.sort_array(F.transform(again, lambda row: row["at"]))

    def covered(at):
        state = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(
            at,
            state,
            lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(x - a["last"], F.lit(WINDOW))).alias("n")),
            lambda a: a["n"],
        )

    # sorting is only paid for by texts that repeat something
    with_repeats = bound(marked, lambda rows: covered(starts(rows)))
    return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)).otherwise(with_repeats)


@dataclass(frozen=True)
class Rule:
    """Rejects and keeps are SQL conditions over the counts; neither holding is abstaining."""

    name: str
    reject: str
    keep: str


RULES = (
    Rule("symbols", "n_symbols > 0.3 * n_words", "n_symbols < 0.05 * n_words"),
    Rule("capitals", "n_capitals > 0.3 * word_chars AND n_words >= 10", "n_capitals < 0.1 * word_chars"),
    Rule("windows", "n_repeat_words > 0.2 * n_words AND n_words >= 50", "n_repeat_words <= 0.05 * n_words"),
    Rule("lines", "n_dup_lines > 0.4 * n_lines", "n_dup_lines <= 0.1 * n_lines"),
    Rule("variety", "n_distinct < 0.3 * n_words AND n_words <= 10000", "n_distinct >= 0.5 * n_words"),
    Rule("stutter", "n_stutters > 0.2 * n_words", "n_stutters < 0.05 * n_words"),
    Rule("word_length", "word_chars < 2.5 * n_words OR word_chars > 14 * n_words", "word_chars BETWEEN 3.5 * n_words AND 7 * n_words"),
    Rule("exclamation", "n_exclaims > 0.5 * n_words", "n_exclaims < 0.05 * n_words"),
    Rule("function_words", "false", "n_function_words >= 2"),
)

COUNTS = (
    "n_words word_chars n_symbols n_lines n_dup_lines n_repeat_words n_distinct n_capitals n_exclaims "
    "n_stutters n_function_words"
).split()


def votes(rules: tuple[Rule, ...] = RULES) -> dict[str, Column]:
    """One column for each rule over the struct column ``c``: 1 keeps, -1 rejects, 0 abstains."""

    def holds(condition: str) -> Column:
        return F.expr(" ".join(f"c.{term}" if term in COUNTS else term for term in condition.split()))

    return {
        rule.name: F.when(holds(rule.reject), REJECT).when(holds(rule.keep), KEEP).otherwise(ABSTAIN)
        for rule in rules
    }


GOOD = "good"
START = {"good": 0.9, "false alarm": 0.01, "own": 0.9, "other": 0.1}
MAX_FALSE_ALARM = 0.02
"""What a rule has to promise: it rejects at most this share of good documents on which it votes."""

MIN_OWN = 0.5
"""A kind of bad document is named by the rule that rejects at least this share of it."""

PSEUDO = 5.0
"""Documents' worth of the start values kept in every estimate; it keeps the classes apart and named."""


@dataclass(frozen=True)
class Model:
    """Share of each class, and how often each rule rejects in it where it votes.

    The classes are the good documents and, since junk of one kind looks fine to the rules against
    other kinds, one class of bad documents for each rule that can reject.
    """

    rules: tuple[str, ...]
    shares: dict[str, float]
    rejects: dict[str, dict[str, float]]

    def likelihoods(self, vote: dict[str, Column]) -> Column:
        """``array<double>``: the logarithm of share times likelihood for each class, the good one first."""
        votes = F.array(*[vote[name] for name in self.rules])
        rates = F.array(
            *[
                F.struct(
                    F.lit(math.log(share)).alias("share"),
                    F.lit([math.log(self.rejects[kind][name]) for name in self.rules]).alias("no"),
                    F.lit([math.log(1 - self.rejects[kind][name]) for name in self.rules]).alias("yes"),
                )
                for kind, share in self.shares.items()
            ]
        )

        def likelihood(rate: Column) -> Column:
            terms = F.transform(
                votes,
                lambda v, j: F.when(v == REJECT, F.get(rate["no"], j)).when(v == KEEP, F.get(rate["yes"], j)).otherwise(0.0),
            )
            return F.aggregate(terms, rate["share"], lambda a, x: a + x)

        return F.transform(rates, likelihood)


def _posteriors(likelihoods: Column) -> Column:
    """``array<double>``: the probability of each class."""

    def normal(parts: Column) -> Column:
        return bound(F.aggregate(parts, F.lit(0.0), lambda a, y: a + y), lambda total: F.transform(parts, lambda x: x / total))

    def scaled(logs: Column) -> Column:
        return bound(F.array_max(logs), lambda top: F.transform(logs, lambda x: F.exp(x - top)))

    return bound(likelihoods, lambda logs: bound(scaled(logs), normal))


def first_model(rules: tuple[Rule, ...]) -> Model:
    names = tuple(rule.name for rule in rules)
    bad = [rule.name for rule in rules if rule.reject != "false"]
    shares = {GOOD: START["good"]} | {kind: (1 - START["good"]) / max(1, len(bad)) for kind in bad}
    return Model(names, shares, {kind: {name: _start(kind, name) for name in names} for kind in shares})


def _start(kind: str, rule: str) -> float:
    return START["false alarm"] if kind == GOOD else START["own" if kind == rule else "other"]


def estimate(histogram: DataFrame, rules: tuple[Rule, ...] = RULES, tolerance: float = 1e-4) -> Model:
    """Expectation maximisation over a histogram of votes: one column for each rule, and ``n``.

    Each step is one aggregate of the histogram, returning for each class and rule the expected
    number of votes and of rejections. Steps go on until neither the share of a class nor
    the share of its documents that a rule rejects moves by ``tolerance`` of all documents.
    """
    model = first = first_model(rules)
    names, kinds = first.rules, list(first.shares)
    while True:
        weighed = histogram.select(
            "n",
            F.array(*[F.col(name) for name in names]).alias("votes"),
            model.likelihoods({name: F.col(name) for name in names}).alias("likelihoods"),
        ).select("n", "votes", F.posexplode(_posteriors(F.col("likelihoods"))).alias("kind", "share"))
        sums = (
            weighed.select("kind", (F.col("n") * F.col("share")).alias("weight"), F.posexplode("votes").alias("rule", "vote"))
            .groupBy("kind", "rule")
            .agg(
                F.sum("weight").alias("rows"),
                F.sum(F.when(F.col("vote") != ABSTAIN, F.col("weight")).otherwise(0.0)).alias("voted"),
                F.sum(F.when(F.col("vote") == REJECT, F.col("weight")).otherwise(0.0)).alias("rejected"),
            )
            .collect()
        )  # as many rows as classes times rules
        if not sums:
            return model
        of = {(kinds[row["kind"]], names[row["rule"]]): row for row in sums}
        weight = {kind: of[kind, names[0]]["rows"] + PSEUDO * first.shares[kind] for kind in kinds}
        shares = {kind: weight[kind] / sum(weight.values()) for kind in kinds}
        rejects = {kind: {} for kind in kinds}
        for kind, name in of:
            rate = (of[kind, name]["rejected"] + PSEUDO * _start(kind, name)) / (of[kind, name]["voted"] + PSEUDO)
            if kind == GOOD:
                rate = min(rate, MAX_FALSE_ALARM)
            elif kind == name:
                rate = max(rate, MIN_OWN)
            rejects[kind][name] = rate
        change = max(
            *(abs(shares[kind] - model.shares[kind]) for kind in kinds),
            *(shares[kind] * abs(rejects[kind][name] - model.rejects[kind][name]) for kind, name in of),
        )
        model = Model(names, shares, rejects)
        if change < tolerance:
            return model


def base_failed() -> Column:
    """The rule that always holds; over the struct ``c``."""
    return (F.col("c.n_words") < MIN_WORDS) | (100 * F.col("c.n_repeat_words") > MAX_REPEATED_PERCENT * F.col("c.n_words"))


def counted(df: DataFrame, text: str = "text", name: str = "c") -> DataFrame:
    """``df`` with the counts of each text as one struct column."""
    prefix = "__q_"
    df = features(df, text, prefix)
    struct = F.struct(*[F.col(f"{prefix}{count}").alias(count) for count in COUNTS])
    return df.withColumn(name, struct).drop(*[f"{prefix}{count}" for count in COUNTS])


def fit(counts: DataFrame, rules: tuple[Rule, ...] = RULES) -> Model:
    """The model for a frame with the struct column ``c``."""
    vote = votes(rules)
    histogram = counts.select(*[column.alias(name) for name, column in vote.items()]).groupBy(*vote).agg(F.count(F.lit(1)).alias("n"))
    # sorted into one file of at most 3 ** rules rows, so that sums of doubles come out alike in each run
    return estimate(written(histogram.coalesce(1).sortWithinPartitions(*vote), "votes"), rules)


def judged(counts: DataFrame, model: Model, rules: tuple[Rule, ...] = RULES, threshold: float = 0.5) -> DataFrame:
    """Adds ``base_failed``, ``posterior`` and ``kept`` to a frame with the struct column ``c``."""
    posterior = F.get(_posteriors(model.likelihoods(votes(rules))), F.lit(0))
    return counts.withColumns(
        {"base_failed": base_failed(), "posterior": posterior, "kept": ~base_failed() & (posterior >= threshold)}
    )


def quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: its counts, ``base_failed``, ``posterior`` and ``kept``."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    counts = written(counted(slim).drop("text"), "quality-counts")
    return judged(counts, fit(counts)).select("doc_id", "c.*", "base_failed", "posterior", "kept")


def filtered(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents the model keeps, with all their columns.

    The counts are made twice, once for the votes and once for the decision: that is cheaper than
    a second copy of the corpus, and neither pass moves a document.
    """
    model = fit(counted(docs.select(F.col(text).alias("text"))).select("c"))
    names = docs.columns
    renamed = docs.toDF(*[f"__d{i}" for i in range(len(names))])
    rows = judged(counted(renamed, f"__d{names.index(text)}"), model)
    # a filter on plain columns would be pushed below the counts and repeat them for every rule;
    # the row number, not being deterministic, keeps it where it is
    kept = rows.withColumn("__row", F.monotonically_increasing_id()).filter(F.col("kept") & (F.col("__row") >= 0))
    return kept.select(*[F.col(f"__d{i}").alias(name) for i, name in enumerate(names)])
