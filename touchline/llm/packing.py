"""Hierarchical residual packing of documents into sequences of bounded length.

1. Where a partition's texts are read, they are encoded, cut into pieces and packed by best fit at
   once: the longest piece first, each into the fullest sequence that still has room. Nearly full
   sequences are finished and written.
2. The underfull ones are items of their own, as long as they are full. They are merged from many tasks into
   fewer and packed again by best fit, and so on.
3. Two sequences that are more than half full never fit together, and a run of best fit leaves at most one
   that is not. So what can still be joined after a round are these few *small* sequences, with each other or each with
   one of the emptiest others, of which as many are enough. They end in one task, and nothing
   that is left then fits together.

A task never holds more than ``task_items`` items; where there are more, it packs them in runs. A
sequence carries its members along, at most one for each token, so no round needs a join.

A NULL text is empty and has only the end id. A document shorter than the limit is never cut; repeated rows
and NULL ids are packed like any others, and an empty table gives no sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.encoding import Encoder, path_of, slices
from touchline.llm.words import written

LIMIT = 2048
END_ID = 0
NEARLY = 16
"""A sequence with at most this many free places is finished."""

TASK_ITEMS = 50_000

_MEMBER = "struct<doc_id: bigint, piece: int, start: bigint, length: int, ids_crc32: bigint, offset: int{ids}>"


def _schema(with_ids: bool) -> str:
    return f"filled int, done boolean, members array<{_MEMBER.format(ids=', ids: array<int>' if with_ids else '')}>"


def best_fit(lengths: np.ndarray, limit: int) -> list[list[int]]:
    """Items in sequences of at most ``limit``: longest first, each where the least room is left over."""
    open_by_room: list[list[int]] = [[] for _ in range(limit + 1)]
    rooms = 0  # bit r is set while a sequence with r free places is open
    out: list[list[int]] = []
    for item in np.argsort(-lengths, kind="stable"):
        length = int(lengths[item])
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            place = open_by_room[room].pop()
            if not open_by_room[room]:
                rooms &= ~(1 << room)
            out[place].append(int(item))
        else:
            room, place = limit, len(out)
            out.append([int(item)])
        left = room - length
        if left:
            open_by_room[left].append(place)
            rooms |= 1 << left
    return out


def _bins(items: list[tuple[int, list[dict]]], limit: int, nearly: int, last: bool) -> Iterator[tuple[int, bool, list[dict]]]:
    """Packs items, each with its length and members, and gives sequences with their members placed."""
    lengths = np.array([length for length, _ in items], dtype=np.int64)
    for chosen in best_fit(lengths, limit):
        members, at = [], 0
        for item in chosen:
            length, inside = items[item]
            members += [member | {"offset": member["offset"] + at} for member in inside]
            at += length
        yield at, last or at >= limit - nearly, members


def _batch(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for low in range(0, len(rows), 2000):
        columns = list(zip(*rows[low : low + 2000], strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _arrow_schema(with_ids: bool) -> pa.Schema:
    member = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("ids_crc32", pa.int64()), ("offset", pa.int32())]
    if with_ids:
        member.append(("ids", pa.list_(pa.int32())))
    return pa.schema([("filled", pa.int32()), ("done", pa.bool_()), ("members", pa.list_(pa.struct(member)))])


def packer_of_texts(path: str, limit: int, nearly: int, with_ids: bool, task_items: int):
    """Encodes, cuts and packs batches of ``doc_id, text``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, schema = Encoder.of(path, special=True), _arrow_schema(with_ids)
        waiting: list[tuple[int, list[dict]]] = []
        for batch in slices(batches):
            ids, places = encoder.encode(batch.column(1))
            numbers = batch.column(0).to_pylist()
            full = []
            for number, low, high in zip(numbers, places[:-1].tolist(), places[1:].tolist(), strict=True):
                own = np.append(ids[low:high], np.uint32(END_ID)).astype("<u4")
                for piece, start in enumerate(range(0, len(own), limit)):
                    part = own[start : start + limit]
                    member = {"doc_id": number, "piece": piece, "start": start, "length": len(part), "ids_crc32": zlib.crc32(part.tobytes()), "offset": 0}
                    if with_ids:
                        member["ids"] = part.astype(np.int32)
                    if len(part) >= limit - nearly:
                        full.append((len(part), True, [member]))
                    else:
                        waiting.append((len(part), [member]))
            yield from _batch(full, schema)
            if len(waiting) >= task_items:
                yield from _batch(list(_bins(waiting, limit, nearly, False)), schema)
                waiting = []
        yield from _batch(list(_bins(waiting, limit, nearly, False)), schema)

    return pack


def packer_of_bins(limit: int, nearly: int, last: bool, with_ids: bool, task_items: int):
    """Packs underfull sequences as items."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow_schema(with_ids)
        waiting: list[tuple[int, list[dict]]] = []
        for batch in batches:
            waiting += zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)
            if not last and len(waiting) >= task_items:
                yield from _batch(list(_bins(waiting, limit, nearly, last)), schema)
                waiting = []
        yield from _batch(list(_bins(waiting, limit, nearly, last)), schema)

    return pack


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    limit: int = LIMIT,
    nearly: int = NEARLY,
    with_ids: bool = False,
    task_items: int = TASK_ITEMS,
) -> DataFrame:
    """One row for each piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` and, if wanted, ``ids``."""
    path = tokenizer or path_of("word_bpe_49k.json")
    schema = _schema(with_ids)
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))


    def kept(packed: DataFrame) -> DataFrame:
        """A round with a number for each sequence, written so that it stays what it is."""
        return written(packed.select("filled", "done", "members").withColumn("bin", F.monotonically_increasing_id()), "packed")

    rounds = [kept(slim.mapInArrow(packer_of_texts(path, limit, nearly, with_ids, task_items), schema))]
    # dealt by members, sorted for equal results in each run
    key = F.xxhash64("members.ids_crc32", "members.doc_id", "members.piece")
    small = F.col("filled") * 2 <= limit
    while True:
        under = rounds[-1].filter("NOT done")
        left, few = under.agg(F.count(F.lit(1)), F.count_if(small)).first()
        if not left:
            break
        last = left <= task_items or 2 * few <= task_items
        if last:
            # each small one joins at most one of the others, and none fits where it fits in none of the emptiest
            emptiest = under.filter(~small).orderBy("filled", "bin").limit(few)
            chosen = under if left <= task_items else under.filter(small).unionByName(emptiest)
        else:
            # after the first round small ones only meet their like: the others have had their run with them
            chosen = under if len(rounds) == 1 else under.filter(small)
        parts = 1 if last else max(1, -(-(left if len(rounds) == 1 else few) // task_items))
        dealt = chosen.coalesce(1) if last else chosen.repartition(parts, key)
        dealt = dealt.sortWithinPartitions(F.col("filled").desc(), key)
        packed = dealt.mapInArrow(packer_of_bins(limit, nearly, last, with_ids, task_items), schema)
        if chosen is not under:
            rest = under.filter(~small)
            if last:
                rest = rest.join(emptiest.select("bin"), "bin", "left_anti")
            packed = packed.unionByName(rest.select("filled", F.lit(last).alias("done"), "members"))
        rounds.append(kept(packed))
        if last:
            break
    finished = rounds[0].filter("done")
    for later in rounds[1:]:
        finished = finished.unionByName(later.filter("done"))
    numbered = finished.withColumn("sequence_id", F.monotonically_increasing_id())
    extra = ["m.ids"] if with_ids else []
    return numbered.select("sequence_id", F.explode("members").alias("m")).select(
        "m.doc_id", "m.piece", "m.start", F.col("m.length").cast("long").alias("length"), "m.ids_crc32", "sequence_id", F.col("m.offset").cast("long").alias("offset"), *extra
    )
