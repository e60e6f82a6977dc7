"""Column expressions, mostly against DuckDB's functions of the same meaning."""

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from helpers import rows
from touchline import functions as fn
from touchline.functions.text import _accent_table


def one(spark, **columns):
    return spark.range(1).select(*[value.alias(name) for name, value in columns.items()]).first()


def test_surrogate_key(spark):
    row = one(
        spark,
        plain=fn.surrogate_key("match", F.lit("1"), F.lit("23")),
        same=fn.surrogate_key("match", F.lit("12"), F.lit(3)),
        apart=fn.surrogate_key("match", F.lit("12"), F.lit(3), separator="|"),
        unknown=fn.surrogate_key("match", F.lit("1"), F.lit(None).cast("string")),
    )
    digest = duckdb.sql("SELECT 'match_' || md5('123')").fetchall()[0][0]
    assert row.plain == row.same == digest
    assert row.apart != row.plain and row.unknown is None


def test_accents_follow_the_rule_everywhere(spark):
    text = "".join(chr(c) for c in range(0xC0, 0x3000))
    expected = duckdb.execute("SELECT strip_accents(?)", [text]).fetchall()[0][0]
    found = one(spark, bare=fn.without_accents(F.lit(text))).bare
    letters, plain = _accent_table()
    assert len(plain) > 800 and len(letters) > len(plain)
    assert found == expected
    assert fn_slug(spark, "Campeonato Brasileiro Série A") == "campeonato_brasileiro_serie_a"
    assert fn_slug(spark, "Łódź ø Ñandú") == duckdb.execute("SELECT strip_accents('łódź_ø_ñandú')").fetchall()[0][0]


def fn_slug(spark, text):
    return one(spark, slug=fn.slug(F.lit(text))).slug


def test_text(spark):
    row = one(
        spark,
        words=fn.code_to_words(F.lit("IN_PLAY")),
        joined=fn.join_present(F.lit("a"), F.lit(None).cast("string"), F.lit(1)),
        pieces=fn.split_text(F.lit("Red / White.+ / "), " / "),
        unknown=fn.split_text(F.lit(None).cast("string"), " / "),
    )
    assert (row.words, row.joined, row.pieces, row.unknown) == ("in play", "a1", ["Red", "White.+", ""], None)


def test_weeks_of_many_years(spark):
    days = spark.range(0, 20000, 3).select(F.date_add(F.lit("1995-12-25").cast("date"), F.col("id").cast("int")).alias("d"))
    found = days.select("d", fn.week_number("d"), fn.day_of_week("d"), fn.week_start("d"), fn.week_end("d"))
    for day, week, weekday, monday, sunday in found.collect():
        assert week == day.isocalendar().week
        assert weekday == day.isoweekday() % 7
        assert monday == day - dt.timedelta(days=day.weekday())
        assert sunday == monday + dt.timedelta(days=6)


def test_completed_years_agree_with_duckdb(spark):
    starts = [dt.date(y, m, d) for y in (1960, 1995, 2000, 2001) for m, d in ((1, 1), (2, 28), (2, 29), (3, 1), (12, 31), (7, 31)) if (m, d) != (2, 29) or y % 4 == 0]
    ends = [dt.date(y, m, d) for y in (2000, 2001, 2024, 2025) for m, d in ((1, 1), (2, 27), (2, 28), (3, 1), (12, 30), (12, 31), (7, 30))]
    pairs = [(s, e) for s in starts for e in ends]
    df = spark.createDataFrame(pairs, "s date, e date")
    found = [row[0] for row in df.select(fn.completed_years("s", "e")).collect()]
    expected = [duckdb.execute("SELECT date_sub('year', ?::DATE, ?::DATE)", list(pair)).fetchall()[0][0] for pair in pairs]
    assert list(zip(pairs, found)) == list(zip(pairs, expected))


def test_partial_dates(spark):
    row = one(
        spark,
        month=fn.month_text_to_date(F.lit("2024-07")),
        unknown=fn.month_text_to_date(F.lit(None).cast("string")),
        dirty=fn.month_text_to_date(F.lit("soon"), strict=False),
        year=fn.year_to_date(F.lit(1904.0)),
        start=fn.month_start(F.lit("2024-07-31 23:59:59").cast("timestamp_ntz")),
    )
    assert tuple(row) == (dt.date(2024, 7, 1), None, None, dt.date(1904, 1, 1), dt.datetime(2024, 7, 1))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, bad=fn.month_text_to_date(F.lit("soon")))


def test_lists(spark):
    data = [(1, [(7,), (None,), (9,)]), (2, []), (3, None)]
    df = spark.createDataFrame(data, "k int, squad array<struct<id:bigint>>")
    found = df.select("k", fn.pluck("squad", "id").alias("ids"))
    found = found.select("k", "ids", fn.list_length("ids"), fn.holds("ids", F.lit("9")))
    assert rows(found) == [(1, ["7", None, "9"], 3, True), (2, None, None, None), (3, None, None, None)]
