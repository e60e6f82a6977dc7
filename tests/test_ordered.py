"""Ordered scans: plain and segmented against a brute-force pass."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from touchline.operators.batches import batches
from touchline.operators.ordered import (
    following,
    ordered,
    previous,
    row_number,
    running_count,
    running_max,
    running_sum,
)

SCHEMA = "k string, at int, id int, v int"


def sample(n, seed, hot=0.6):
    rnd = random.Random(seed)
    return [
        (
            None if rnd.random() < 0.05 else "hot" if rnd.random() < hot else f"k{rnd.randrange(9)}",
            rnd.randrange(6),
            i,
            None if rnd.random() < 0.2 else rnd.randrange(-50, 50),
        )
        for i in range(n)
    ]


def brute(data):
    """k, id and the seven scans, by walking each group in order."""
    found = []
    for key in {row[0] for row in data}:
        group = sorted((r for r in data if r[0] == key), key=lambda r: (-r[1], r[2]))
        total, count, largest = None, 0, None
        for i, (_, _, ident, value) in enumerate(group):
            before = largest
            if value is not None:
                total = value if total is None else total + value
                largest = value if largest is None else max(largest, value)
                count += value > 0
            found.append(
                (
                    key,
                    ident,
                    total,
                    count,
                    largest,
                    before,
                    group[i - 1][3] if i else None,
                    group[i + 1][3] if i + 1 < len(group) else None,
                    i + 1,
                )
            )
    return sorted(found, key=lambda row: tuple((x is None, str(x)) for x in row))


def scanned(df, **limits):
    groups = ordered(df, ["k"], [F.col("at").desc_nulls_last(), F.col("id")], **limits)
    result = groups.scan(
        total=running_sum("v"),
        positive=running_count(F.col("v") > 0),
        largest=running_max("v"),
        largest_before=running_max("v", before_row=True),
        before=previous("v"),
        after=following("v"),
        place=row_number(),
    )
    return groups, result.rows.drop("at", "v").select(
        "k", "id", "total", "positive", "largest", "largest_before", "before", "after", "place"
    )


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("segment_rows", [None, 40, 7])
def test_scans_equal_brute_force(spark, seed, segment_rows):
    data = sample(300, seed)
    limits = {} if segment_rows is None else {"max_group_rows": 20, "segment_rows": segment_rows}
    groups, found = scanned(spark.createDataFrame(data, SCHEMA), **limits)
    assert groups.segmented == (segment_rows is not None)
    assert rows(found) == brute(data)


def test_one_group_of_equal_order_values_is_cut(spark):
    data = [("hot", 1, i, 1) for i in range(500)]
    groups, found = scanned(spark.createDataFrame(data, SCHEMA), max_group_rows=50, segment_rows=50)
    assert groups.segmented
    assert rows(found) == brute(data)
    # no segment holds much more than it should
    sizes = groups._df.groupBy("__segment").count().collect()
    assert len(sizes) >= 8 and max(row["count"] for row in sizes) <= 150


def test_empty_frame(spark):
    empty = spark.createDataFrame([], SCHEMA)
    _, found = scanned(empty)
    assert found.collect() == []


def test_known_sizes_are_trusted(spark):
    df = spark.createDataFrame(sample(100, 3), SCHEMA)
    sizes = spark.createDataFrame([("any", 10**9, 10**9)], "k string, rows long, total long")
    assert ordered(df, ["k"], ["id"], sizes=sizes, segment_rows=10**8).segmented
    assert not ordered(df, ["k"], ["id"], sizes=sizes.filter("rows < 0")).segmented


def test_scan_after_scan_uses_the_first(spark):
    data = sample(200, 5)
    df = spark.createDataFrame(data, SCHEMA)

    def changes(**limits):
        groups = ordered(df, ["k"], [F.col("id")], **limits).scan(before=previous("v"))
        flagged = groups.with_columns(up=F.coalesce(F.col("v") > F.col("before"), F.lit(True)).cast("int"))
        return rows(flagged.scan(n=running_sum("up")).rows)

    assert changes() == changes(max_group_rows=10, segment_rows=15)


@pytest.mark.parametrize("partitions", [None, 1, 7, 300])
def test_batches(spark, partitions):
    ids = spark.range(0, 505, 2).select((F.col("id") * 7 % 1010).alias("id"))
    cut = batches(ids, "id", 100, partitions)
    assert "SinglePartition" not in cut._jdf.queryExecution().executedPlan().toString()
    found = {row.id: row.batch for row in cut.collect()}
    assert found == {ident: i // 100 for i, ident in enumerate(sorted(found))}
    assert len(found) == 253


def test_batches_of_ties_nulls_and_nothing(spark):
    ids = spark.createDataFrame([(x,) for x in [3, 3, None, 1, None, 2]], "id long")
    assert sorted((r.batch, r.id is None, r.id or 0) for r in batches(ids, "id", 2, 3).collect()) == [
        (0, False, 1), (0, False, 2), (1, False, 3), (1, False, 3), (2, True, 0), (2, True, 0),
    ]
    assert batches(ids.limit(0), "id").count() == 0
