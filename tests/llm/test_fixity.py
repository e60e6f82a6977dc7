import hashlib

import pytest
from pyspark.sql import functions as F

from touchline.llm import fixity as f


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://x/{i}", "<p>" + "é" * (i % 50)) for i in range(300)]
    rows += [(None, None, None), (None, "u", ""), (5, "http://x/5", "<p>ééééé"), (1000, None, "y" * 100_000)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("offset", F.lit(1))


@pytest.fixture(scope="module")
def original(pages):
    return f.archive(pages, file_bytes=20_000)


def test_records_are_placed_without_gaps(original, pages):
    rows = original.collect()
    assert len(rows) == pages.count() and len({r.file for r in rows}) > 3
    at = {}
    for r in sorted(rows, key=lambda r: (r.file, r.offset)):
        assert r.offset == at.get(r.file, 0) and r.length == len(r.record)
        at[r.file] = r.offset + r.length
        head, body = bytes(r.record).split(b"\r\n\r\n", 1)
        assert head.startswith(b"WARC/1.1\r\nWARC-Type: resource\r\n") and body.endswith(b"\r\n\r\n")
        assert f"Content-Length: {len(body) - 4}".encode() in head
        assert f"urn:sha256:{hashlib.sha256(body[:-4]).hexdigest()}".encode() in head


def plain_root(rows, stride, end, fanout):
    level = [(r.file * stride + r.offset, f"{r.length} {r.sha256}") for r in rows]
    width = f.BLOCK
    while True:
        groups = {}
        for node, line in sorted(level):
            groups.setdefault(node // width, []).append(f"{node} {line}")
        level = [(node, hashlib.sha256("\n".join(lines).encode()).hexdigest()) for node, lines in groups.items()]
        end, width = -(-end // width), fanout
        if end <= 1:
            return level


def test_root_against_plain_lists(original):
    listed = f.manifest(original)
    stride, end = f.space(listed)
    root = f.tree(f.leaves_of(listed, stride), end, 4).levels[-1].collect()
    assert [tuple(r) for r in root] == plain_root(listed.collect(), stride, end, 4) and len(root) == 1


def test_sound_replica(original):
    listed = f.manifest(original)
    # copies and another order of rows change nothing
    replica = original.unionByName(original.limit(5)).repartition(3)
    assert {r.state for r in f.audited(listed, replica).collect()} == {"intact"}


@pytest.mark.parametrize("wanted", [[0], [7, 8, 9], [17, 290], list(range(40, 90, 3))])
def test_damage_is_located(original, wanted):
    listed = f.manifest(original)
    places = {r.leaf: (r.file, r.offset) for r in listed.collect()}
    bad = F.lit(False)
    for leaf in wanted:
        bad = bad | ((F.col("file") == places[leaf][0]) & (F.col("offset") == places[leaf][1]))
    flipped = original.withColumn("record", F.when(bad, F.expr("overlay(record PLACING X'00' FROM 12 FOR 1)")).otherwise(F.col("record")))
    lost = original.filter(~bad)
    cut = original.withColumn("length", F.when(bad, F.col("length") - 1).otherwise(F.col("length")))
    more = original.unionByName(original.filter(bad).withColumn("record", F.encode(F.lit("other"), "utf-8")))
    for state, replica in {"changed": flipped, "missing": lost, "resized": cut}.items():
        found = f.audited(listed, replica, fanout=4).filter("NOT intact").collect()
        assert sorted(r.leaf for r in found) == wanted and {r.state for r in found} == {state}
    found = f.audited(listed, more, fanout=4).filter("NOT intact").collect()
    assert sorted(r.leaf for r in found) == wanted  # two records at one address


def test_records_only_the_replica_has(original):
    listed = f.manifest(original)
    last = original.agg(F.max("file")).first()[0]
    appended = original.filter("page_id = 8").withColumns({"file": F.lit(last), "offset": F.lit(10**7).cast("long")})
    new_file = original.filter("page_id = 9").withColumns({"file": F.lit(last + 3), "offset": F.lit(0).cast("long")})
    between = original.filter("page_id = 10").withColumn("offset", F.col("offset") + 1)
    nowhere = original.filter("page_id IN (11, 12)").withColumn("offset", F.lit(None).cast("long"))
    replica = original.unionByName(appended).unionByName(new_file).unionByName(between).unionByName(nowhere)
    rows = f.audited(listed, replica).filter("NOT intact").collect()
    assert {r.state for r in rows} == {"extra"} and all(r.leaf is None and r.page_id is None for r in rows)
    here = original.filter("page_id = 10").first()
    assert {(r.file, r.offset) for r in rows} == {(last, 10**7), (last + 3, 0), (here.file, here.offset + 1), (None, None)}
    sums = {r.page_id: hashlib.sha256(bytes(r.record)).hexdigest() for r in original.filter("page_id IN (8, 9, 10)").collect()}
    assert set(sums.values()) <= {r.sha256 for r in rows} and len(rows) == 4


def test_empty_sides(original, pages):
    nothing, listed = f.archive(pages.limit(0)), f.manifest(original)
    assert {r.state for r in f.audited(listed, nothing).collect()} == {"missing"}
    rows = f.audited(f.manifest(nothing), original).collect()
    assert len(rows) == original.count() and {r.state for r in rows} == {"extra"}


def test_empty(pages):
    nothing = f.archive(pages.limit(0))
    listed = f.manifest(nothing)
    assert f.audited(listed, nothing).count() == 0
