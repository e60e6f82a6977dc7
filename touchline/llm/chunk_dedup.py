"""Substring deduplication: content-defined chunks, deduplicated by digest, extended to the exact passage.

A chunk ends where a gear rolling hash over the last ``WINDOW`` bytes is smallest among ``REACH`` bytes on either
side, so the same passage is cut at the same places wherever it stands and whatever was inserted before it, and hardly
any 100 bytes go without a cut. Chunks in a row that all occur in other documents make a *run*.
The chunks across the two ends of a passage differ between documents, so runs are extended: the chunks at
a run's ends are anchors, every place that has an anchor digests the text between it and each word
beginning before it (ending behind it), and the farthest word whose digest other documents have too is the passage's end.
A passage of at least ``MIN_WORDS`` words is reported.

One pass over the texts cuts and digests them; one row per document is written, with its chunks in
arrays. Digests are then counted: smallest and largest document per digest, combined before the
shuffle, so a chunk that a third of all documents share costs one row for each task. The chunks
of repeated digests are found by a join, whose skew Spark splits. Only runs that can reach ``MIN_WORDS`` have anchors,
an anchor's surroundings are a chunk and some bytes, and their digests are counted like those of chunks;
no two documents are ever compared.

A NULL or empty text has no chunk; documents without a number cannot be named and are left out;
rows repeating a document's number are that document again, so they repeat nothing. A passage that repeats
within one document only is no repeat across documents. Parts of a passage may stand in different documents. Text whose
hash repeats within ``REACH`` bytes, such as one short word over and over, is cut every ``LONGEST`` bytes from its last cut on and
found only where that is the same.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.encoding import slices
from touchline.llm.words import written

WINDOW = 16
REACH = 20
LONGEST = 1024
MIN_WORDS = 50
_SEED = 11
_LAST = np.uint64(2**64 - 1)

# Bytes next to a passage's ends where its cuts still depend on what surrounds it. Cuts are more than
# REACH apart, so of a run's chunks one of the first three and one of the last two lies between common cuts.
_BEFORE, _BEHIND = WINDOW + REACH, REACH
_FIRST, _FINAL = 3, 2
_LEFT, _RIGHT = 0, 1


def _gear() -> np.ndarray:
    return np.random.Generator(np.random.PCG64(_SEED)).integers(0, 2**64 - 1, 256, dtype=np.uint64)


def rolling(data: np.ndarray, gear: np.ndarray) -> np.ndarray:
    """At each byte ``sum(gear[byte k back] << k)`` over the window: doubled from 1 to ``WINDOW`` bytes."""
    total, width = gear[data], 1
    while width < WINDOW:
        further = total.copy()
        further[width:] += total[:-width] << np.uint64(width)
        total, width = further, 2 * width
    return total


def lowest(values: np.ndarray, count: int) -> np.ndarray:
    """At each place the smallest of the ``count`` values up to it: doubled, then once more for the rest."""
    total, width = values.copy(), 1
    while 2 * width <= count:
        total[width:] = np.minimum(total[width:], total[:-width])
        width *= 2
    rest = count - width
    if rest:
        further = total.copy()
        further[rest:] = np.minimum(total[rest:], total[:-rest])
        total = further
    return total


def boundaries(data: np.ndarray, starts: np.ndarray, gear: np.ndarray) -> np.ndarray:
    """Where chunks begin, texts beginning at ``starts``; sorted."""
    # the value of a place is the hash of the bytes before it; room behind the end for the last windows
    value = np.full(len(data) + REACH + 1, _LAST)
    value[1 : len(data)] = (rolling(data, gear) * np.uint64(0x9E3779B97F4A7C15))[:-1]
    for near in range(max(WINDOW, REACH)):  # there a window would reach into another text
        at = starts + near
        value[at[at < len(data)]] = _LAST
    value[: len(data)][(data & 0xC0) == 0x80] = _LAST  # never inside a character
    around = lowest(value, REACH)
    own = value[1 : len(data)]
    cut = np.zeros(len(data), dtype=bool)
    cut[1:] = (own < around[: len(data) - 1]) & (own <= around[REACH + 1 : len(data) + REACH])
    cut[starts] = True
    found = np.flatnonzero(cut)
    gaps = np.diff(np.append(found, len(data)))
    long = np.flatnonzero(gaps > LONGEST)
    if len(long):
        forced = np.concatenate([np.arange(found[i] + LONGEST, found[i] + gaps[i], LONGEST) for i in long])
        for _ in range(3):  # back to the beginning of a character
            forced = np.where((data[forced] & 0xC0) == 0x80, forced - 1, forced)
        found = np.unique(np.concatenate([found, forced]))
    return found


def packed_place(start: np.ndarray, size: np.ndarray, words: np.ndarray) -> np.ndarray:
    return (start << 32) | (size << 16) | words


def packed_around(before: np.ndarray, behind: np.ndarray, words_before: np.ndarray, words_behind: np.ndarray) -> np.ndarray:
    return (before << 48) | (behind << 32) | (words_before << 16) | words_behind


def chunker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id, text`` to ``doc_id, places, around, digests``; places in code points."""
    gear, digest = _gear(), xxhash.xxh3_64_intdigest
    for batch in slices(batches, 4 * 1024 * 1024):
        texts = batch.column(1).cast(pa.large_string()).fill_null("")
        raw = texts.to_pylist()
        encoded = [text.encode("utf-8", "surrogatepass") for text in raw]
        whole = b"".join(encoded)
        sizes = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded))
        ends = np.cumsum(sizes)
        starts = (ends - sizes)[sizes > 0]
        data = np.frombuffer(whole, dtype=np.uint8)
        if not len(data):
            found = np.zeros(0, dtype=np.int64)
        else:
            found = boundaries(data, starts, gear)
        stops = np.append(found[1:], len(data)) if len(found) else found
        points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        blank = (data == 32) | ((data >= 9) & (data <= 13))
        first = ~blank
        first[1:] &= blank[:-1]
        if len(starts):
            first[starts] = ~blank[starts]
        words = np.concatenate(([0], np.cumsum(first)))
        origin = points[(ends - sizes)]
        owner = np.searchsorted(ends, found, side="right")
        place = packed_place(points[found] - origin[owner], points[stops] - points[found], words[stops] - words[found])
        # what surrounds a chunk: the one before it and the one behind it, with the bytes that cuts depend on
        origins, limits = (ends - sizes)[owner], ends[owner]
        before = np.maximum(np.where(found > origins, np.append(0, found[:-1]), found) - _BEFORE, origins)
        before = np.where(found > origins, before, found)
        behind = np.where(stops < limits, np.minimum(np.append(stops[1:], len(data)) + _BEHIND, limits), stops)
        around = packed_around(points[found] - points[before], points[behind] - points[stops], words[found] - words[before], words[behind] - words[stops])
        codes = np.fromiter((digest(whole[a:b]) for a, b in zip(found.tolist(), stops.tolist(), strict=True)), dtype=np.uint64, count=len(found))
        offsets = pa.array(np.searchsorted(found, np.append(0, ends)).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.ListArray.from_arrays(offsets, pa.array(place, pa.int64())),
                pa.ListArray.from_arrays(offsets, pa.array(around, pa.int64())),
                pa.ListArray.from_arrays(offsets, pa.array(codes.view(np.int64), pa.int64())),
            ],
            names=["doc_id", "places", "around", "digests"],
        )


@dataclass(frozen=True)
class Chunk:
    start: int
    stop: int
    words: int
    around: int
    digest: int
    first: int

    @property
    def before(self) -> int:
        return self.around >> 48

    @property
    def behind(self) -> int:
        return (self.around >> 32) & 0xFFFF


def _in_a_row(chunks: Iterable[Chunk]) -> list[list[Chunk]]:
    out: list[list[Chunk]] = []
    for chunk in chunks:
        if out and out[-1][-1].stop == chunk.start:
            out[-1].append(chunk)
        else:
            out.append([chunk])
    return out


def _runs(chunks: Iterable) -> list[list[Chunk]]:
    """The repeated chunks of a document, those next to each other together."""
    told = sorted({(int(c["place"]), int(c["around"]), int(c["digest"]), int(c["first"])) for c in chunks})
    return _in_a_row(Chunk(*_unpacked(place), around, digest, first) for place, around, digest, first in told)


def _spare(run: list[Chunk], doc_id: int) -> list[list[Chunk]]:
    """The parts of a run whose chunks all stand in earlier documents."""
    return _in_a_row(chunk for chunk in run if chunk.first != doc_id)


def _reaches(run: list[Chunk]) -> bool:
    """Whether a run can have ``MIN_WORDS`` words once it is extended."""
    return sum(c.words for c in run) + ((run[0].around >> 16) & 0xFFFF) + (run[-1].around & 0xFFFF) >= MIN_WORDS


def _asked(part: list[Chunk]) -> Iterator[tuple[int, int, int]]:
    """``digest, side, distance``: what lies farther than that from the chunk lies beyond the part."""
    for chunk in part[:_FIRST]:
        if chunk.before > chunk.start - part[0].start:
            yield chunk.digest, _LEFT, chunk.start - part[0].start
    for chunk in part[-_FINAL:]:
        if chunk.behind > part[-1].stop - chunk.stop:
            yield chunk.digest, _RIGHT, part[-1].stop - chunk.stop


def _anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Digests whose surroundings are asked for, with the distance from which on they are on either side."""
    for batch in batches:
        nearest: dict[tuple[int, int], int] = {}
        for doc_id, chunks in zip(batch["doc_id"], batch["chunks"], strict=True):
            for run in _runs(chunks):
                for part in [run, *_spare(run, doc_id)] if _reaches(run) else []:
                    for digest, side, distance in _asked(part) if _reaches(part) else ():
                        nearest[digest, side] = min(distance, nearest.get((digest, side), distance))
        out = [(digest, *((distance, None) if side == _LEFT else (None, distance))) for (digest, side), distance in nearest.items()]
        yield pd.DataFrame(out, columns=["digest", "left", "right"]).astype({"digest": "int64", "left": "Int64", "right": "Int64"})


def surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id, text, anchors`` to a row for each word beginning before an anchor and each ending behind it.

    ``key`` digests the text between them; ``word`` is the side, the distance in code points and the words begun in it.
    """
    word, digest = re.compile(r"[^\x20\x09-\x0D]+"), xxhash.xxh3_64_intdigest
    names = ["doc_id", "start", "word", "key"]

    def keys(text: str, anchor: dict) -> Iterator[tuple[int, int]]:
        chunk = Chunk(*_unpacked(anchor["place"]), anchor["around"], anchor["digest"], 0)
        start, stop, seed = chunk.start, chunk.stop, chunk.digest & 0xFFFFFFFFFFFFFFFF
        # rows that repeat a document's number may have another text
        if digest(text[start:stop].encode("utf-8", "surrogatepass")) != seed:
            return
        if anchor["left"] is not None:
            begin = start - chunk.before
            begins = [m.start() + begin for m in word.finditer(text[begin:start])]
            if begins and begins[0] == begin > 0 and word.match(text[begin - 1]):
                del begins[0]
            for n, at in enumerate(reversed(begins), 1):
                if start - at > anchor["left"]:
                    yield _packed_word(_LEFT, start - at, n), digest(text[at:start].encode("utf-8", "surrogatepass"), seed)
        if anchor["right"] is not None:
            end, n = stop + chunk.behind, 0
            for m in word.finditer(text[stop:end]):
                n += m.start() > 0 or not word.match(text[stop - 1])
                at = m.end() + stop
                if at - stop > anchor["right"] and (at < end or end == len(text) or not word.match(text[end])):
                    yield _packed_word(_RIGHT, at - stop, n), digest(text[stop:at].encode("utf-8", "surrogatepass"), seed ^ 0xFFFFFFFFFFFFFFFF)

    for batch in slices(batches, 4 * 1024 * 1024):
        columns: list[list[int]] = [[] for _ in names]
        for doc_id, text, anchors in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            for anchor in anchors if text else ():
                for at, key in keys(text, anchor):
                    for column, value in zip(columns, (doc_id, anchor["place"] >> 32, at, key - ((key >> 63) << 64)), strict=True):
                        column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], names=names)


def _unpacked(place: int) -> tuple[int, int, int]:
    start, size = place >> 32, (place >> 16) & 0xFFFF
    return start, start + size, place & 0xFFFF


def _packed_word(side: int, distance: int, n: int) -> int:
    return (side << 32) | (distance << 16) | n


def _extended(part: list[Chunk], reach: dict[tuple[int, int], int]) -> tuple[int, int, int]:
    """Start, stop and words of chunks in a row together with what ``reach`` adds at their ends."""
    start, stop, words = part[0].start, part[-1].stop, sum(chunk.words for chunk in part)
    added, inside = 0, 0
    for chunk in part[:_FIRST]:
        far = reach.get((chunk.start, _LEFT), 0)
        if chunk.start - ((far >> 16) & 0xFFFF) < start:
            start, added = chunk.start - ((far >> 16) & 0xFFFF), (far & 0xFFFF) - inside
        inside += chunk.words
    words += added
    added, inside = 0, 0
    for chunk in reversed(part[-_FINAL:]):
        far = reach.get((chunk.start, _RIGHT), 0)
        if chunk.stop + ((far >> 16) & 0xFFFF) > stop:
            stop, added = chunk.stop + ((far >> 16) & 0xFFFF), (far & 0xFFFF) - inside
        inside += chunk.words
    return start, stop, words + added


def _passages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs become passages; those long enough are kept."""
    for batch in batches:
        out = []
        for doc_id, chunks, reaches in zip(batch["doc_id"], batch["chunks"], batch["reaches"], strict=True):
            some, earlier = {}, {}
            for r in reaches if reaches is not None else ():
                some[r["start"], r["side"]] = r["some"]
                earlier[r["start"], r["side"]] = r["earlier"]
            for run in _runs(chunks):
                start, stop, words = _extended(run, some)
                if words < MIN_WORDS:
                    continue
                spare = [_extended(part, earlier) for part in _spare(run, doc_id)]
                spare = [part for part in spare if part[2] >= MIN_WORDS]
                # the document that most of it is first found in
                firsts = Counter()
                for chunk in run:
                    firsts[chunk.first] += chunk.words
                main = min(firsts, key=lambda first: (-firsts[first], first))
                out.append((doc_id, start, stop, words, main, sum(n for _, _, n in spare), [[a, b] for a, b, _ in spare]))
        yield pd.DataFrame(out, columns=["doc_id", "start", "stop", "n_words", "first_doc_id", "n_spare_words", "spare"])


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each passage that other documents repeat, in each document that has it.

    ``doc_id, start, stop`` (code points, end exclusive; a blank that its copies share may stand at either end), ``n_words``; ``first_doc_id`` is the
    document most of it is first found in; ``spare`` are the parts that earlier documents have, ``n_spare_words`` their words.
    """
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).filter("doc_id IS NOT NULL")
    lists = "doc_id long, places array<bigint>, around array<bigint>, digests array<bigint>"
    cut = written(slim.mapInArrow(chunker, lists), "chunks")
    digests = cut.select("doc_id", F.explode("digests").alias("digest"))
    shared = written(_shared(digests, "digest").select("digest", "first"), "shared")
    chunks = cut.select("doc_id", F.explode(F.arrays_zip("places", "around", "digests")).alias("c")).select(
        "doc_id", F.col("c.places").alias("place"), F.col("c.around").alias("around"), F.col("c.digests").alias("digest")
    )
    chunk = F.struct("place", "around", "digest", "first")
    found = written(chunks.join(shared, "digest").groupBy("doc_id").agg(F.collect_list(chunk).alias("chunks")), "found")

    asked = found.mapInPandas(_anchors, "digest long, left long, right long")
    asked = written(asked.groupBy("digest").agg(F.min("left").alias("left"), F.min("right").alias("right")), "anchors")
    places = found.select("doc_id", F.explode("chunks").alias("c")).select("doc_id", "c.place", "c.around", "c.digest").join(asked, "digest")
    places = places.filter("shiftright(around, 48) > left OR (shiftright(around, 32) & 65535) > right")
    places = places.groupBy("doc_id").agg(F.collect_set(F.struct("place", "around", "digest", "left", "right")).alias("anchors"))
    keys = written(slim.join(places, "doc_id").mapInArrow(surroundings, "doc_id long, start long, word long, key long"), "keys")
    reaches = (
        keys.join(_shared(keys, "key").select("key", "first"), "key")
        .groupBy("doc_id", "start", F.expr("shiftright(word, 32)").alias("side"))
        .agg(F.max("word").alias("some"), F.max(F.when(F.col("first") < F.col("doc_id"), F.col("word")).otherwise(0)).alias("earlier"))
    )
    reaches = reaches.groupBy("doc_id").agg(F.collect_list(F.struct("start", "side", "some", "earlier")).alias("reaches"))
    return found.join(reaches, "doc_id", "left").select("doc_id", "chunks", "reaches").mapInPandas(
        _passages,
        "doc_id long, start long, stop long, n_words long, first_doc_id long, n_spare_words long, spare array<array<bigint>>",
    )


def _shared(rows: DataFrame, key: str) -> DataFrame:
    """Keys that several documents have, with the first and the last of these."""
    return rows.groupBy(key).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the spare parts of repeats cut out of their texts: a passage stays in its first document."""
    names = docs.columns
    rows = docs.toDF(*[f"__d{i}" for i in range(len(names))])
    number, words = f"__d{names.index(doc_id)}", f"__d{names.index(text)}"
    # neighbours may overlap by some words, but passages are too long for one to lie in another
    spare = repeats(docs, doc_id, text).select("doc_id", F.explode("spare").alias("part"))
    spare = written(spare.groupBy("doc_id").agg(F.sort_array(F.collect_set("part")).alias("parts")), "spare")
    joined = rows.join(spare, rows[number].cast("long") == spare["doc_id"], "left")
    ends = F.array_append(F.transform("parts", lambda part: part[0]), F.length(words).cast("long"))
    begins = F.array_prepend(F.transform("parts", lambda part: part[1]), F.lit(0).cast("long"))
    left = F.array_join(
        F.zip_with(begins, ends, lambda a, b: F.substring(F.col(words), (a + 1).cast("int"), F.greatest(b - a, F.lit(0)).cast("int"))), ""
    )
    cut = joined.withColumn(words, F.when(F.col("parts").isNull(), F.col(words)).otherwise(left))
    return cut.select(*[F.col(f"__d{i}").alias(name) for i, name in enumerate(names)])
