"""Mixing sources to target weights with a curriculum that changes over training time.

*Targets.* Sources share a total by weight, none above a multiple of its own size; what a capped source
leaves is shared again among the others. That is one water level: ``min(cap, level * weight)``
summing to the total, found from running sums over the sources in the order they get capped.

*Curriculum.* Each source has a weight schedule over training time from 0 to 1, linear between
knots. Its integral, scaled to the target, says how many of its words have been asked for at any
time. A source's documents lie in a fixed random order on a line of words, repeated while
the target asks for more; a document's training position is the time at which the demand reaches
its place, the inverse of that integral. Sorting by position gives the training order.

Running sums over a source do not need the source in one task: the random order is cut into cells
by hash, the cells' sums are added up, and the sum within a cell starts from there. The number
of cells grows with the corpus.

Documents are taken whole, so a source misses its target by less than one document. A NULL text
has no words and is never taken; NULL sources are one source, ordered last; repeated rows are
separate documents of their own; an empty table gives an empty mixture.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchline.llm.words import words_of, written

CELL_ROWS = 2_000
"""Documents aimed at per cell of the random order."""


@dataclass(frozen=True)
class Mixture:
    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    """Weights of the sources in code point order, repeating."""

    share: float = 1.5
    """Words in the mixture over words in the corpus."""

    cap: float = 2.0
    """Most a source or a document is used."""

    schedules: tuple[tuple[tuple[float, float], ...], ...] = (
        ((0.0, 1.2), (1.0, 0.8)),
        ((0.0, 1.0), (1.0, 1.0)),
        ((0.0, 0.5), (0.7, 0.8), (1.0, 2.5)),
    )
    """``(time, relative weight)`` knots for each weight above: the heaviest sources fade, the lightest come late."""


def targets(sizes: DataFrame, mix: Mixture) -> DataFrame:
    """Adds ``weight``, ``schedule`` (its number) and ``target`` to one row per source with ``size``.

    Sources are few next to documents: one row each, aggregated before.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("schedule", (F.row_number().over(order) - 1) % len(mix.weights))
    weight = F.get(F.array(*[F.lit(float(w)) for w in mix.weights]), F.col("schedule").cast("int"))
    ranked = ranked.withColumns({"weight": weight, "cap": F.col("size") * mix.cap})
    # in the order in which a rising level caps them
    rising = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = rising.rowsBetween(W.unboundedPreceding, -1)
    total = F.sum("size").over(W.partitionBy()) * F.lit(mix.share)
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rising.rowsBetween(0, W.unboundedFollowing))
    # the first source whose cap the level does not reach sets it for all that come after
    fits = F.when(level * F.col("weight") <= F.col("cap"), level)
    leveled = ranked.withColumn("fits", fits).withColumn("level", F.first("fits", ignorenulls=True).over(rising.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    target = F.least("cap", F.coalesce(F.col("level"), F.lit(float("inf"))) * F.col("weight"))
    return leveled.withColumn("target", target).drop("fits", "level", "cap")


def demand_inverse(knots: Sequence[tuple[float, float]], part: Column) -> Column:
    """The time at which a schedule has asked for ``part``, 0 to 1, of all it will ask for."""
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:], strict=False)]
    whole, done, out = sum(areas), 0.0, None
    for (t0, w0), (t1, w1), area in zip(knots, knots[1:], areas, strict=False):
        left = F.greatest(part * whole - done, F.lit(0.0))
        slope = (w1 - w0) / (t1 - t0)
        # w0 x + slope x^2 / 2 = left, in the form that also holds for a slope of 0
        x = 2 * left / (w0 + F.sqrt(F.greatest(w0 * w0 + 2 * slope * left, F.lit(0.0))))
        time = F.least(t0 + F.coalesce(x, F.lit(0.0)), F.lit(t1))
        done += area
        out = F.when(part * whole <= done, time) if out is None else out.when(part * whole <= done, time)
    return out.otherwise(F.lit(knots[-1][0]))


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", mix: Mixture = Mixture(), carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id, source, size, source_size, target, times, taken, positions`` and the columns carried along.

    ``positions`` has a training position for each time the document is used, in order. Rows
    are sorted by the first of them, unused documents last.
    """
    slim = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.size(words_of(F.col(text))).cast("long").alias("size"), F.xxhash64(F.col(text), F.col(doc_id)).alias("place"), *carry
    )
    slim = written(slim, "sizes")
    totals = slim.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"))
    sources = written(targets(totals, mix), "targets").withColumnRenamed("size", "source_size")

    # cells of the random order, and where each begins
    cells = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("rows") / CELL_ROWS))
    of_source = sources.select(F.col("source").alias("s"), "source_size", "target", "schedule", cells.alias("cells"))
    placed = slim.join(of_source, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    placed = placed.withColumn("cell", F.pmod(F.xxhash64("place"), F.col("cells")))
    sums = placed.groupBy("source", "cell").agg(F.sum("size").alias("words"))
    earlier = W.partitionBy("source").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    begins = written(
        sums.select(F.col("source").alias("s"), F.col("cell").alias("c"), F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("begin")), "cells"
    )
    within = W.partitionBy("source", "cell").orderBy("place", "doc_id").rowsBetween(W.unboundedPreceding, -1)
    local = placed.withColumn("ahead", F.coalesce(F.sum("size").over(within), F.lit(0)))
    lined = local.join(begins, F.col("source").eqNullSafe(F.col("s")) & (F.col("cell") == F.col("c")))
    # a document is used in each pass in which its middle lies before the end of the demand
    middle = F.col("begin") + F.col("ahead") + F.col("size") / 2
    times = F.when(F.col("size") == 0, 0).otherwise(F.ceil((F.col("target") - middle) / F.col("source_size")))
    times = F.least(F.greatest(times, F.lit(0)), F.lit(int(mix.cap))).cast("int")
    part = lambda k: (k * F.col("source_size") + F.col("begin") + F.col("ahead")) / F.col("target")

    def position(k: Column) -> Column:
        out = None
        for number, knots in enumerate(mix.schedules):
            time = demand_inverse(knots, part(k))
            out = F.when(F.col("schedule") == number, time) if out is None else out.when(F.col("schedule") == number, time)
        return out

    used = lined.withColumn("times", times).withColumn(
        "positions",
        F.when(F.col("times") > 0, F.transform(F.sequence(F.lit(0), F.col("times") - 1), position)).otherwise(F.expr("array() :: array<double>")),
    )
    return used.select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"), "times", "positions", *carry
    )


def mixture(docs: DataFrame, **options) -> DataFrame:
    """What :func:`mixed` returns, range-sorted by the position of first use."""
    rows = mixed(docs, **options)
    return rows.orderBy(F.get("positions", F.lit(0)).asc_nulls_last(), "doc_id")


def training_order(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", mix: Mixture = Mixture()) -> DataFrame:
    """The documents in training order: each one as often as it is used, unused ones not at all.

    Positions are worked out on slim rows without texts. These meet the texts once, by two hashes of the
    whole row, and are then sorted by range. Rows equal in all columns share their key, so one of them takes the
    positions of all.
    """
    names = docs.columns
    plain = docs.toDF(*[f"__d{i}" for i in range(len(names))])
    of = {name: f"__d{names.index(name)}" for name in (doc_id, text, source)}
    kinds = dict(plain.dtypes)
    # maps have no hash of their own
    hashed = [F.array_sort(F.map_entries(name)) if kinds[name].startswith("map<") else F.col(name) for name in plain.columns]
    keyed = plain.withColumns({"__a": F.xxhash64(*hashed), "__b": F.xxhash64(F.lit(8), *reversed(hashed))})
    keys = ["__a", "__b"]
    used = written(mixed(keyed, of[doc_id], of[text], of[source], mix, carry=keys).select(*keys, F.explode("positions").alias("__position")), "uses")
    repeated = written(keyed.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select(*keys), "repeats")
    if not repeated.isEmpty():
        once = keyed.join(repeated, keys, "left_semi").dropDuplicates(keys)
        keyed = keyed.join(repeated, keys, "left_anti").unionByName(once)
    # uses grow with the corpus, so both sides are sorted at any size instead of being broadcast while they are few
    each = keyed.join(used.hint("merge"), keys)
    return each.orderBy("__position", of[doc_id], *keys).select(*[F.col(f"__d{i}").alias(name) for i, name in enumerate(names)])
