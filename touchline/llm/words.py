"""What several operators share: words, match positions and written intermediate tables."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.sources.tables import scratch_table

SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

_RUN = 512
"""Matches whose places are summed in one go; longer lists are cut, so that work stays near linear."""


def shipped(spark: SparkSession) -> None:
    """Give the workers this package where they would not find it by themselves."""
    root = Path(__file__).resolve().parents[2]
    context = spark.sparkContext
    reachable = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    found = any(os.path.realpath(path or ".") == str(root) for path in reachable)
    # what the driver finds in its own folders says nothing about executors elsewhere
    local = context.master == "local" or context.master.startswith("local[")
    if (local and found) or any("touchline-" in x for x in context.listFiles):
        return
    handle, archive = tempfile.mkstemp(prefix="touchline-", suffix=".zip")
    with os.fdopen(handle, "wb") as file, zipfile.ZipFile(file, "w") as packed:
        for source in (root / "touchline").rglob("*.py"):
            packed.write(source, source.relative_to(root))
    context.addPyFile(archive)  # sent by the driver's own file server


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: later steps read it and lost executors cost nothing."""
    return scratch_table(df, name)


def words_of(text: Column) -> Column:
    """The words of a text in order; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A to Z as a to z and nothing else changed. Only a text with capitals beyond ASCII goes character by character."""
    others = r"[\p{Lu}\p{Lt}\p{Nl}\p{So}&&[^A-Z]]"
    return F.when(text.rlike(others), F.translate(text, _UPPER, _LOWER)).otherwise(F.lower(text))


SET_BITS = 1 << 20
"""Bits in a set of hashes: 16,384 longs, whatever the corpus."""


def _places(key: Column, size: int) -> tuple[Column, Column]:
    return F.pmod(key, F.lit(size)), F.pmod(F.call_function("shiftright", key, F.lit(32)), F.lit(size))


def _longs(keys: DataFrame, key: str, size: int) -> DataFrame:
    """``word, bits``: the longs of a set of ``size`` bits that are not 0."""
    bits = keys.select(F.explode(F.array(*_places(F.col(key), size))).alias("bit"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bit") % 64).cast("int"))
    return bits.groupBy(F.floor(F.col("bit") / 64).cast("int").alias("word")).agg(F.bit_or(one).alias("bits"))


def bit_set(keys: DataFrame, key: str) -> Column:
    """The hashes in ``key`` as a set of ``SET_BITS`` bits, two for each; see :func:`marked`."""
    longs = ["0"] * (SET_BITS // 64)
    # at most SET_BITS / 64 rows
    for row in _longs(keys, key, SET_BITS).collect():
        longs[row["word"]] = str(row["bits"])
    return F.split(F.lit(",".join(longs)), ",").cast("array<bigint>")


def sized_bit_set(keys: DataFrame, key: str, most: int) -> tuple[Column, int]:
    """A set with at least 16 bits for each hash, but never more than ``most`` in all, and its size.

    It is a subquery of one row, so it cannot stand inside a lambda.
    """
    size = min(most, 1 << max(10, (16 * keys.count()).bit_length()))
    every = keys.sparkSession.range(0, size // 64, 1, 1).select(F.col("id").cast("int").alias("word"))
    whole = every.join(_longs(keys, key, size), "word", "left")
    # one row of at most ``most`` / 64 longs
    row = whole.agg(F.sort_array(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))).alias("all"))
    return written(row.select(F.col("all.bits").alias("bits")), "bits").scalar(), size


def marked(bits: Column, key: Column, size: int | None = None) -> Column:
    """Whether a hash may be in the set: always true for its members, and for few others while those are few."""

    def has(place: Column) -> Column:
        held = F.get(bits, F.call_function("shiftright", place, F.lit(6)).cast("int"))
        return F.call_function("shiftrightunsigned", held, (place % 64).cast("int")).bitwiseAND(F.lit(1)) == 1

    first, second = _places(key, size or SET_BITS)
    return has(first) & has(second)


def bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def n_chars(text: Column) -> Column:
    return F.length(text).cast("long")


def gaps_of(text: Column, pattern: str) -> Column:
    """What stands before, between and after the matches of a pattern."""
    return F.split(text, pattern, -1)


def matches_of(text: Column, pattern: str) -> Column:
    """All leftmost, non-overlapping matches of a pattern."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def placed(gaps: Column, matches: Column) -> Column:
    """``array<struct<start, stop, value, gap>>`` in code points, ``gap`` being the text before the match.

    The places are running sums over the lengths of gaps and matches. They are summed in runs,
    first the runs, then within each, so that a text with a million matches stays feasible.
    """
    nothing = F.expr(f"array() :: array<{_PLACED}>")

    def paired(found: Column) -> Column:
        pairs = F.zip_with(
            F.slice(found["gaps"], F.lit(1), F.size(found["matches"])),
            found["matches"],
            lambda gap, value: F.struct(gap.alias("gap"), value.alias("value"), n_chars(gap).alias("skip"), n_chars(value).alias("size")),
        )
        return F.when(F.size(found["matches"]) > 0, bound(pairs, _summed)).otherwise(nothing)

    # each step is bound to a name: an expression used inside a lambda is computed for each element
    return bound(F.struct(gaps.alias("gaps"), matches.alias("matches")), paired)


_PLACED = "struct<start: bigint, stop: bigint, value: string, gap: string>"


def _summed(pairs: Column) -> Column:
    def place(row, at):
        return F.struct(
            (at + row["skip"]).alias("start"),
            (at + row["skip"] + row["size"]).alias("stop"),
            row["value"].alias("value"),
            row["gap"].alias("gap"),
        )

    def run(rows, offset):
        start = F.struct(offset.alias("at"), F.expr(f"array() :: array<{_PLACED}>").alias("done"))
        return F.aggregate(
            rows,
            start,
            lambda state, row: F.struct(
                (state["at"] + row["skip"] + row["size"]).alias("at"),
                F.array_append(state["done"], place(row, state["at"])).alias("done"),
            ),
            lambda state: state["done"],
        )

    def run_of(rows, i):
        return F.slice(rows, i * _RUN + 1, F.lit(_RUN))

    def total(rows):
        return F.aggregate(rows, F.lit(0).cast("long"), lambda a, row: a + row["skip"] + row["size"])

    def in_runs(totals: Column) -> Column:
        return F.flatten(
            F.transform(
                totals,
                lambda _, i: run(
                    run_of(pairs, i),
                    F.aggregate(F.slice(totals, F.lit(1), i), F.lit(0).cast("long"), lambda a, x: a + x),
                ),
            )
        )

    last = F.floor((F.size(pairs) - 1) / _RUN).cast("int")
    totals = F.transform(F.sequence(F.lit(0), last), lambda i: total(run_of(pairs, i)))
    return F.when(F.size(pairs) <= _RUN, run(pairs, F.lit(0).cast("long"))).otherwise(bound(totals, in_runs))
