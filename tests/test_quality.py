"""Checks: what fails, what passes, what an unknown value does."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from touchline.operators import quality as q
from touchline.operators.ordered import previous
from touchline.plans.checks import extra_checks

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def df(spark):
    data = [(1, "a", 5, [1, 2]), (2, "b", None, []), (2, None, 12, None), (None, "cc", -1, [3, None]), (None, "a", 7, [9])]
    return spark.createDataFrame(data, "id int, name string, x int, items array<int>").cache()


def failing_ids(check, df):
    return [tuple(row) for row in check.failing(df).select("id", "name").collect()]


@pytest.mark.parametrize(
    "check, expected",
    [
        (lambda: q.not_null("x"), [(2, "b")]),
        (lambda: q.not_null("id", where="name = 'a'"), [(None, "a")]),
        (lambda: q.accepted_values("name", ["a", "b"]), [(None, "cc")]),
        (lambda: q.accepted_range("x", 0, 10), [(2, None), (None, "cc")]),
        (lambda: q.accepted_range("x", 5), [(None, "cc")]),
        (lambda: q.accepted_range("x", 5, 12, inclusive=False), [(1, "a"), (2, None), (None, "cc")]),
        (lambda: q.accepted_range("x", high=F.col("id") * 5), [(2, None)]),
        (lambda: q.expression_is_true("x > 5"), [(1, "a"), (None, "cc")]),
        (lambda: q.expression_is_true("x > 5", where="id = 1"), [(1, "a")]),
        (lambda: q.length_equals("name", 1), [(None, "cc")]),
        (lambda: q.length_between("name", 2, 3, where="id = 1"), [(1, "a")]),
        (lambda: q.greater_than("x", "id"), []),
        (lambda: q.greater_than("id", "x", or_equal=True), [(1, "a"), (2, None)]),
        (lambda: q.min_list_length("items", 0), [(2, "b")]),
        (lambda: q.min_list_length("items", 2, or_equal=True), [(2, "b"), (None, "a")]),
    ],
)
def test_row_checks(df, check, expected):
    check = check()
    assert failing_ids(check, df) == expected
    # the fused count is the same as the number of failing rows
    assert q.run_checks(df, [check]).first().failures == len(expected)


def test_unique(df):
    assert rows(q.unique("id").failing(df)) == [(2, 2)]
    assert rows(q.unique("name").failing(df)) == [("a", 2)]
    assert rows(q.unique("name", where="id IS NOT NULL").failing(df)) == []
    assert rows(q.unique_combination(["id"]).failing(df)) == [(2, 2), (None, 2)]


def test_relationships(spark, df):
    parent = spark.createDataFrame([(1,), (3,), (None,), (3,)], "k int")
    check = q.relationships("id", parent, "k")
    assert rows(check.failing(df)) == [(2, 2)]
    assert check.count(df).first().failures == 2
    assert rows(q.relationships("id", parent, "k", where="name = 'b'").failing(df)) == [(2, 1)]
    assert rows(q.relationships("id", parent, "k", parent_where="k = 3").failing(df)) == [(1, 1), (2, 2)]
    elements = q.list_relationships("items", parent, "k")
    assert rows(elements.failing(df)) == [(2, 1), (9, 1), (None, 1)]


def test_counts_and_minimum(df):
    assert rows(q.equal_counts("name", "a", "b").failing(df)) == [("a", 2), ("b", 1)]
    assert rows(q.equal_counts("name", "cc", "b").failing(df)) == []
    assert q.minimum_after("x", F.lit(-2)).failing(df).count() == 0
    assert q.minimum_after("x", F.lit(-1)).failing(df).count() == 5


def test_elements(spark):
    lists = spark.createDataFrame([(1, [T0, T0 + dt.timedelta(days=9)]), (2, []), (3, None)], "id int, ats array<timestamp_ntz>")
    check = q.no_element_after("ats", F.lit(dt.date(2024, 1, 5)), "at")
    assert rows(check.failing(lists)) == [(1, T0 + dt.timedelta(days=9))]
    assert q.run_checks(lists, [check]).first().failures == 1


@pytest.mark.parametrize("limits", [{}, {"max_group_rows": 5, "segment_rows": 12}])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_overlaps_equal_brute_force(spark, limits, seed):
    rnd = random.Random(seed)
    data = []
    for i in range(120):
        start = rnd.randrange(300)
        end = start + rnd.choice([0, 1, 3, 30 if rnd.random() < 0.1 else 2])
        data.append((i, rnd.choice(["u", "v", None]), None if rnd.random() < 0.05 else start, None if rnd.random() < 0.1 else end))
    df = spark.createDataFrame(data, "id int, k string, s int, e int")
    found = q.no_overlapping_periods("s", "e", "id", ["k"], **limits).failing(df)
    complete = [r for r in data if None not in r]
    expected = {
        a[0] for a in complete for b in complete if a[0] != b[0] and a[1] == b[1] and a[2] < b[3] and a[3] > b[2]
    }
    assert {row.id for row in found.collect()} == expected and expected


@pytest.mark.parametrize("limits", [{}, {"max_group_rows": 2, "segment_rows": 2}])
def test_only_the_latest_may_be_open(spark, limits):
    data = [("a", 1, None), ("a", 2, 5), ("a", 3, None), ("b", 1, None), ("b", 2, 3)]
    df = spark.createDataFrame(data, "k string, at int, until int")
    assert rows(q.not_null_but_latest("until", ["k"], "at", **limits).failing(df)) == [("a", 1, None)]


def test_conditions_on_the_row_before(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 4), ("a", 3, 9), ("b", 1, 1)], "k string, at int, x int")
    check = q.scan_is_true("x >= before", ["k"], ["at"], {"before": previous("x")})
    assert rows(check.failing(df)) == [("a", 2, 4)]
    assert rows(q.scan_is_true("x >= before", ["k"], ["at"], {"before": previous("x")}, where="at <> 2").failing(df)) == []


def test_extra_checks(spark):
    found = extra_checks(F.lit(dt.date(2025, 1, 1)))
    born = spark.createDataFrame([(dt.date(1980, 1, 1),), (dt.date(2000, 1, 1),)], "date_of_birth date")
    assert found["players"][0].count(born).first().failures == 0
    data = [("t", "c", "s", "1", T0, T0 + dt.timedelta(days=1)), ("t", "c", "s", "2", T0 + dt.timedelta(days=2), None)]
    history = spark.createDataFrame(
        data,
        "team_id string, competition_id string, season_id string, match_id string, "
        "version_start_at timestamp_ntz, version_end_at timestamp_ntz",
    )
    assert found["standings_versions"][0].count(history).first().failures == 1


def test_suite_and_requirement(df):
    checks = [q.not_null("x").warn(), q.unique("id"), q.accepted_range("x", -5, 50)]
    assert rows(q.run_checks(df, checks)) == [
        ("accepted_range(x)", "error", 0),
        ("not_null(x)", "warn", 1),
        ("unique(id)", "error", 1),
    ]
    assert q.require(df, [checks[0], checks[2]]) is df
    with pytest.raises(q.ChecksFailed, match=r"unique\(id\): 1"):
        q.require(df, checks)


def test_row_checks_share_one_scan(df):
    many = [q.not_null("id"), q.accepted_range("x", 0, 1), q.length_equals("name", 1)]
    plan = q.run_checks(df.select("*"), many)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("InMemoryRelation") == 1


def test_empty_frame(df):
    empty = df.filter("false")
    checks = [q.not_null("id"), q.unique("id"), q.equal_counts("name", "a", "b")]
    assert [row.failures for row in q.run_checks(empty, checks).collect()] == [0, 0, 0]


def test_stacked_checks_equal_each_on_its_own(spark):
    """Uniques, combinations and foreign keys of several types, counted together."""
    rnd = random.Random(8)
    pick = lambda some: rnd.choice([*some, None])
    data = [(pick(range(9)), pick("abc"), pick([0.5, -0.0, 0.0]), [pick(range(12)) for _ in range(rnd.randrange(4))] or None, T0 + dt.timedelta(days=pick([1, 2]) or 0)) for _ in range(60)]
    df = spark.createDataFrame(data, "id int, name string, x double, ids array<int>, at timestamp_ntz")
    parent = spark.createDataFrame([(k, "a" if k == 2 else None) for k in [1, 2, 3, None, 3]], "k int, s string")
    wide = parent.select(F.col("k").cast("bigint").alias("k"))
    checks = [
        q.unique("id"), q.unique("id", where="name = 'a'"), q.unique("x"), q.unique("at"), q.unique_combination(["id", "name"]),
        q.unique_combination(["id"]), q.unique_combination(["name", "at"], where="id > 3"), q.unique_combination(["id", "x"]),
        q.relationships("id", parent, "k"), q.relationships("id", parent, "k", where="name = 'b'"), q.relationships("id", parent, "k", parent_where="k > 1"),
        q.relationships("id", wide, "k"), q.relationships("name", parent, "s").warn(), q.list_relationships("ids", parent, "k"),
    ]
    for frame in (df, df.limit(0)):
        found = [(r.check, r.severity, r.failures) for r in q.run_checks(frame, checks).collect()]
        assert sorted(found) == sorted((c.name, c.severity, c.count(frame).first().failures) for c in checks)


def test_shared_checks_scan_once(df):
    parent = df.sparkSession.range(3)
    many = [q.unique("id"), q.unique("name"), q.relationships("id", parent.select(F.col("id").cast("int").alias("id")), "id")]
    plan = q.run_checks(df.select("*"), many)._jdf.queryExecution().optimizedPlan().toString()
    assert "InMemoryRelation" not in plan  # what is left reads the counted values only
