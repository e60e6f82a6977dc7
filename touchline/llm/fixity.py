"""WARC archives and their fixity: Merkle trees over records, compared from the root down.

An archive is a table of WARC records at their byte offsets, in files of bounded size; the record's
bytes are what a WARC file holds there. Its *manifest* keeps, for each record, offset, length and SHA-256.

Each replica has a tree of its own, built from the records it holds. Its leaves are those records by address,
which is the file's share of one address space and the offset in it. A node above the leaves covers ``BLOCK`` bytes of
addresses, a node above that ``FANOUT`` of those, and hashes the ordered addresses, lengths and hashes below it. So a
changed, missing, resized or additional record changes the nodes above it and no others. Two replicas are
compared at the root; only below nodes that differ is the next level looked at, by a join with the children
of those nodes. Sound replicas cost one comparison.

Defined cases: NULL url or html are written as empty; pages without a number come first and are told apart
by their content; repeated rows are records of their own; an empty table has no record, and its tree no node. A replica's record without file or offset stands at
no address of the manifest, so it is reported as extra, all of those together as one; a record that a replica lists
twice is one record, and different records at one address are a changed one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchline.llm.words import written

FANOUT = 16
BLOCK = 4096
"""Bytes of addresses below one node of the lowest level; records of 150 bytes or more make that 28 children at most."""

NOWHERE = -1
"""Address of records without a place."""

FILE_BYTES = 64 * 1024 * 1024
DATE = "2000-01-01T00:00:00Z"
"""Pages carry no time of capture, so all records get this one."""


def record_of(url: Column, html: Column) -> Column:
    """The bytes of a WARC resource record."""
    body = F.coalesce(html, F.lit(""))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:sha256:"),
        F.sha2(body, 256),
        F.lit(f">\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.encode(F.concat(head, body, F.lit("\r\n\r\n")), "utf-8")


def _located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the file, which is the partition, and the offset in it."""
    file, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        sizes = [len(record) for record in batch.column(1).to_pylist()]
        offsets = []
        for size in sizes:
            offsets.append(at)
            at += size
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([file] * len(sizes), pa.int32()), pa.array(offsets, pa.int64()), pa.array(sizes, pa.int64()), batch.column(1)],
            names=["page_id", "file", "offset", "length", "record"],
        )


def archive(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", file_bytes: int = FILE_BYTES) -> DataFrame:
    """``page_id, file, offset, length, record``: the pages in order of their number, written as records."""
    records = pages.select(F.col(page_id).cast("long").alias("page_id"), record_of(F.col(url), F.col(html)).alias("record"))
    total = records.agg(F.sum(F.octet_length("record").cast("long"))).first()[0] or 0
    files = max(1, -(-total // file_bytes))
    order = [F.col("page_id").asc_nulls_first(), F.xxhash64("record"), F.md5("record")]
    dealt = records.repartitionByRange(files, *order).sortWithinPartitions(*order)
    return written(dealt.mapInArrow(_located, "page_id long, file int, offset long, length long, record binary"), "archive")


def manifest(table: DataFrame) -> DataFrame:
    """``file, offset, length, sha256, leaf, start``: one row per record; ``leaf`` and ``start`` count through all files."""
    leaves = table.select("page_id", "file", "offset", "length", F.sha2("record", 256).alias("sha256"))
    # files are few; within a file, records are few enough for one sort of their numbers
    totals = leaves.groupBy("file").agg(F.count(F.lit(1)).alias("records"), F.sum("length").alias("bytes"))
    earlier = W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)
    begins = totals.select(
        F.col("file"),
        F.coalesce(F.sum("records").over(earlier), F.lit(0)).alias("first"),
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("before"),
    )
    within = W.partitionBy("file").orderBy("offset")
    numbered = leaves.withColumn("place", F.row_number().over(within) - 1).join(begins, "file")
    return written(
        numbered.select("page_id", "file", "offset", "length", "sha256", (F.col("first") + F.col("place")).alias("leaf"), (F.col("before") + F.col("offset")).alias("start")),
        "manifest",
    )


@dataclass(frozen=True)
class Tree:
    """Levels from the leaves up; each has ``node, hash``, the leaves' nodes being addresses. The last one is the root."""

    levels: list[DataFrame]


def space(*tables: DataFrame) -> tuple[int, int]:
    """``(stride, end)``: addresses that a file gets, and the address behind the last file of all tables."""
    stride, files = 1, 0
    for table in tables:
        last = table.agg(F.max("offset").alias("offset"), F.max("file").alias("file")).first()
        stride = max(stride, (last["offset"] or 0) + 1)
        files = max(files, 0 if last["file"] is None else last["file"] + 1)
    return stride, stride * files


def address(stride: int) -> Column:
    return F.coalesce(F.col("file").cast("long") * stride + F.col("offset"), F.lit(NOWHERE).cast("long"))


def leaves_of(records: DataFrame, stride: int) -> DataFrame:
    """``node, hash`` of records with ``file, offset, length, sha256``: one leaf for each address that has a record."""
    line = F.concat_ws(" ", F.coalesce(F.col("length").cast("string"), F.lit("?")), F.coalesce("sha256", F.lit("?")))
    held = records.groupBy(address(stride).alias("node")).agg(F.min(line).alias("one"), F.max(line).alias("other"))
    return written(held.select("node", F.when(F.col("one") == F.col("other"), F.col("one")).otherwise(F.concat_ws(" or ", "one", "other")).alias("hash")), "leaves")


def tree(leaves: DataFrame, end: int, fanout: int = FANOUT) -> Tree:
    """The tree over the leaves of addresses below ``end``."""
    level, levels, width = leaves, [leaves], BLOCK
    while True:
        child = F.struct("node", F.concat_ws(" ", F.col("node").cast("string"), "hash").alias("line"))
        grouped = level.groupBy(F.floor(F.col("node") / width).alias("node")).agg(F.sort_array(F.collect_list(child)).alias("children"))
        level = written(grouped.select("node", F.sha2(F.array_join(F.transform("children", lambda c: c["line"]), "\n"), 256).alias("hash")), "level")
        levels.append(level)
        end, width = -(-end // width), fanout
        if end <= 1:
            return Tree(levels)


def mismatches(first: Tree, second: Tree, fanout: int = FANOUT) -> DataFrame | None:
    """``node, hash, their_hash`` of the leaves in which two trees over the same addresses differ; None if the roots agree.

    A leaf that only one tree has is NULL in the other's hash.
    """
    suspects, width = None, None
    for depth in range(len(first.levels) - 1, -1, -1):
        mine, theirs = first.levels[depth], second.levels[depth].withColumnRenamed("hash", "their_hash")
        if suspects is not None:
            parents = suspects.select(F.col("node").alias("parent"))
            width = BLOCK if depth == 0 else fanout
            mine, theirs = (side.join(parents, F.floor(F.col("node") / width) == F.col("parent"), "left_semi") for side in (mine, theirs))
        pair = mine.join(theirs, "node", "full").filter(~F.col("hash").eqNullSafe(F.col("their_hash")))
        suspects = written(pair.select("node", "hash", "their_hash"), "suspects")
        if suspects.isEmpty():
            return None
    return suspects


def audited(listed: DataFrame, replica: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """The manifest with what a replica holds at each record's place, and the records that only the replica has.

    ``state`` is ``intact``, ``changed``, ``resized`` or ``missing``, and ``extra`` for rows that the manifest lacks: these
    have file, offset, length and hash of the replica and no number, leaf or start. ``intact`` says that the state is.
    """
    there = replica.select("file", "offset", "length", F.sha2("record", 256).alias("sha256"))
    stride, end = space(listed, replica)
    mine, theirs = leaves_of(listed, stride), leaves_of(there, stride)
    found = mismatches(tree(mine, end, fanout), tree(theirs, end, fanout), fanout)
    if found is None:
        return listed.withColumns({"state": F.lit("intact"), "intact": F.lit(True)})
    length = {side: F.substring_index(side, " ", 1) for side in ("hash", "their_hash")}
    state = (
        F.when(F.col("their_hash").isNull(), "missing")
        .when(length["hash"] != length["their_hash"], "resized")
        .otherwise("changed")
    )
    bad = found.filter("hash IS NOT NULL").select("node", state.alias("bad"))
    judged = listed.withColumn("node", address(stride)).join(bad, "node", "left").withColumn("state", F.coalesce("bad", F.lit("intact")))
    judged = judged.select(*listed.columns, "state", (F.col("state") == "intact").alias("intact"))
    placed = F.col("node") != NOWHERE
    extra = found.filter("hash IS NULL").select(
        F.when(placed, F.floor(F.col("node") / stride)).cast("int").alias("file"),
        F.when(placed, F.pmod("node", F.lit(stride))).cast("long").alias("offset"),
        F.expr("try_cast(substring_index(their_hash, ' ', 1) AS bigint)").alias("length"),
        F.substring_index(F.substring_index("their_hash", " or ", 1), " ", -1).alias("sha256"),
        F.lit("extra").alias("state"),
        F.lit(False).alias("intact"),
    )
    return judged.unionByName(extra, allowMissingColumns=True)
