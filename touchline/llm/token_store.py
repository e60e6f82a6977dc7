"""Token ids of documents in range-coded, checksummed blocks, and their reading.

The store is a Parquet table of *segments*. A segment holds whole documents in ascending order, their numbers
and lengths, and their ids as a list of blocks as ``range_coder`` writes them: each block is reset and
checksummed by itself. Spark's writer commits the files, so a lost executor leaves nothing half written, and any file
system Spark reaches will do.

Ids must be below 65536. A NULL text has only the end id; documents without a number come first;
repeated numbers stay apart, ordered by content; an empty table is an empty store.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from touchline.llm import range_coder
from touchline.llm.encoding import Encoder, path_of, slices
from touchline.llm.words import written

END_ID = 0
SEGMENT_IDS = range_coder.BLOCK_IDS * range_coder.LANES
SEGMENT = "part int, segment int, doc_ids array<bigint>, lengths array<bigint>, blocks array<binary>"


def encoder_of(path: str, segment_ids: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = Encoder.of(path, special=True), TaskContext.get().partitionId()
        held: list[np.ndarray] = []
        numbers: list = []
        lengths: list[int] = []
        segment, size = 0, 0

        def flushed() -> pa.RecordBatch:
            row = [[part], [segment], [numbers], [lengths], [range_coder.encode(np.concatenate(held))]]
            types = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.binary())]
            names = ["part", "segment", "doc_ids", "lengths", "blocks"]
            return pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip(row, types, strict=True)], names=names)

        for batch in slices(batches):
            ids, places = encoder.encode(batch.column(1))
            for number, low, high in zip(batch.column(0).to_pylist(), places[:-1].tolist(), places[1:].tolist(), strict=True):
                held.append(np.append(ids[low:high], np.uint32(END_ID)))
                numbers.append(number)
                lengths.append(high - low + 1)
                size += high - low + 1
                if size >= segment_ids:
                    yield flushed()
                    held, numbers, lengths = [], [], []
                    segment, size = segment + 1, 0
        if numbers:
            yield flushed()

    return encode


def stored(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None, segment_ids: int = SEGMENT_IDS) -> DataFrame:
    """Writes the documents' ids in ascending order of their numbers and returns the table of segments."""
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = slim.repartitionByRange(*order).sortWithinPartitions(*order)
    path = tokenizer or path_of("byte_bpe_50k.json")
    return written(dealt.mapInArrow(encoder_of(path, segment_ids), SEGMENT), "ids")


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document of each segment from the blocks' ids; a damaged block stops the reading."""
    for batch in batches:
        for part, segment, numbers, lengths, blocks in zip(*[batch.column(i).to_pylist() for i in range(5)], strict=True):
            ids = range_coder.decode(blocks)
            stops = np.cumsum(lengths)
            starts = stops - lengths
            if stops[-1] != len(ids):
                raise ValueError(f"segment {part}:{segment} has {len(ids)} ids, its documents {stops[-1]}")
            sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
            columns = [numbers, [part] * len(numbers), [segment] * len(numbers), starts, lengths, sums]
            types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "part", "segment", "inside", "n_tokens", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip(columns, types, strict=True)], names=names)


def index_of(store: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the ids in the store."""
    rows = written(store.mapInArrow(_decoded, "doc_id long, part int, segment int, inside long, n_tokens long, ids_crc32 long"), "read")
    # one row for each segment of millions of ids
    totals = rows.groupBy("part", "segment").agg(F.sum("n_tokens").alias("ids"))
    earlier = W.orderBy("part", "segment").rowsBetween(W.unboundedPreceding, -1)
    begins = totals.select("part", "segment", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("begin"))
    return rows.join(begins, ["part", "segment"]).select("doc_id", (F.col("begin") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
