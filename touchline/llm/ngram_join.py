"""N-gram Jaccard join: MinHash bands find candidates, full n-gram sets decide.

1. One pass over the texts makes, for each document, a digest of its words, its number of n-grams
   and one hash for each MinHash band. Number of bands and rows follow from the target recall.
2. Equal word sequences are one *text*; all further work is done once for each text, so a group of
   copies costs one row and never its pairs.
3. The band hashes are shuffled, not the texts. Texts sharing a band with another are linked to
   the smallest of them; connected, they form *candidate groups* outside of which no link is possible.
4. Only texts of candidate groups are read again. A group is cut into blocks, each pair of blocks
   is one piece of work, and in it all pairs are compared by their full n-gram sets. What comes out is
   linear: links counted for each text, and one edge to the smallest text it is linked with.

No pair list exists at any time, and no partner is left out.

Words are those between ASCII white space. A text of fewer words than ``n`` has one n-gram, all of its
words; a NULL, empty or blank text has none and links with nothing. Rows repeating number and text
count once. Documents without a number come out with their text's class like any others; a class without any
number is named NULL.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.components import components
from touchline.llm.words import SPACES, written

N = 5
THRESHOLD = 0.8
RECALL = 0.9999
ROWS = 6
BLOCK = 512
"""Texts in a block of a candidate group; a piece of work holds two blocks."""

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def bands_for(threshold: float = THRESHOLD, rows: int = ROWS, recall: float = RECALL) -> int:
    """Bands needed for a pair at the threshold to share at least one of them with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class _Codes(dict):
    """Words hashed once and remembered."""

    LIMIT = 500_000

    def __missing__(self, word: str) -> int:
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code


def split_words(text: str | None) -> list[str]:
    """Words between ASCII white space only, unlike ``str.split`` without a separator."""
    if not text:
        return []
    for blank in "\t\n\x0b\x0c\r":
        if blank in text:
            text = text.replace(blank, " ")
    return [word for word in text.split(" ") if word]


class Grams:
    """Hashes of words and of n-grams."""

    def __init__(self, n: int):
        self.n = n
        self.codes = _Codes()

    def words(self, text: str | None) -> np.ndarray:
        if len(self.codes) > _Codes.LIMIT:
            self.codes.clear()
        words = split_words(text)
        return np.fromiter(map(self.codes.__getitem__, words), dtype=np.uint64, count=len(words))

    def of(self, codes: np.ndarray) -> np.ndarray:
        """The set of n-grams, sorted."""
        if not len(codes):
            return codes
        width = min(self.n, len(codes))
        size = len(codes) - width + 1
        total = np.zeros(size, dtype=np.uint64)
        for k in range(width):
            total = _mixed(total * np.uint64(0x9E3779B97F4A7C15) + codes[k : size + k] + np.uint64(k + 1))
        return np.unique(total)


def digest_of(text: Column) -> Column:
    """128 bits that stand for the sequence of words."""
    return F.unhex(F.md5(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " "))))


def _factors(count: int, seed: int = 20) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.Generator(np.random.PCG64(seed))
    odd = random.integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, random.integers(0, 2**63, count, dtype=np.uint64)


def signer(n: int, bands: int, rows: int):
    """The function that adds number of n-grams and band hashes to batches of texts."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams, (odd, shift) = Grams(n), _factors(bands * rows)
        salt = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for batch in batches:
            sizes, keys = [], []
            for text in batch["text"]:
                members = grams.of(grams.words(text))
                sizes.append(len(members))
                if not len(members):
                    keys.append([])
                    continue
                least = np.full(bands * rows, np.iinfo(np.uint64).max)
                for low in range(0, len(members), 1024):  # a slice of all hashes stays in cache
                    part = (members[None, low : low + 1024] ^ shift[:, None]) * odd[:, None]
                    least = np.minimum(least, part.min(axis=1))
                key = salt.copy()
                for row in (least >> np.uint64(24)).reshape(bands, rows).T:
                    key = _mixed(key * _MIX[0] + row)
                keys.append(key.view(np.int64).tolist())
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "digest": batch["digest"], "grams": sizes, "keys": keys})

    return sign


def signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    return docs.mapInPandas(signer(n, bands, rows), "doc_id long, digest binary, grams long, keys array<long>")


def _compared(first: list[np.ndarray], second: list[np.ndarray], threshold: float) -> np.ndarray:
    """For all pairs of sorted sets whether their Jaccard similarity reaches the threshold."""
    sizes_a, sizes_b = np.array([len(x) for x in first]), np.array([len(x) for x in second])
    # only members found on both sides can count
    common, codes = np.intersect1d(np.unique(np.concatenate(first)), np.unique(np.concatenate(second))), []
    for sets in (first, second):
        rows = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        flat = np.concatenate(sets)
        at = np.searchsorted(common, flat)
        at[at == len(common)] = 0
        hit = common[at] == flat if len(common) else np.zeros(len(flat), dtype=bool)
        codes.append((rows[hit], at[hit]))
    shared = np.zeros((len(first), len(second)), dtype=np.float32)
    width = 4096
    for low in range(0, len(common), width):
        parts = []
        for (rows, at), sets in zip(codes, (first, second), strict=True):
            part = np.zeros((len(sets), min(width, len(common) - low)), dtype=np.float32)
            inside = (at >= low) & (at < low + width)
            part[rows[inside], at[inside] - low] = 1
            parts.append(part)
        shared += parts[0] @ parts[1].T
    # counts below 2 ** 24 are exact in float32; the comparison is done in whole numbers of tenthousandths
    shared = shared.astype(np.int64)
    union = sizes_a[:, None] + sizes_b[None, :] - shared
    scale = 10_000
    return (shared * scale >= round(threshold * scale) * union) & (shared > 0)


def verifier(n: int, threshold: float):
    """Compares the two blocks of each piece of work; rows of a piece come one after another."""

    def results(piece: tuple, texts: list, blocks: list, weights: list, ids: list, grams: Grams) -> pd.DataFrame:
        sets = [grams.of(grams.words(text)) for text in texts]
        ids, weights, blocks = np.array(ids), np.array(weights), np.array(blocks)
        same = piece[1] == piece[2]
        a = np.flatnonzero(blocks == piece[1])
        b = a if same else np.flatnonzero(blocks == piece[2])
        links, root = np.zeros(len(ids), dtype=np.int64), ids.copy()
        if len(a) and len(b):
            linked = _compared([sets[i] for i in a], [sets[i] for i in b], threshold)
            if same:
                np.fill_diagonal(linked, False)
            links[a] += linked @ weights[b]
            if not same:
                links[b] += linked.T @ weights[a]
            top = np.iinfo(np.int64).max
            root[a] = np.minimum(root[a], np.where(linked, ids[b][None, :], top).min(axis=1))
            if not same:
                root[b] = np.minimum(root[b], np.where(linked.T, ids[a][None, :], top).min(axis=1))
            root = _settled(root, a, b, linked, same)
        return pd.DataFrame({"text_id": ids, "links": links, "root": root})

    def _settled(root, a, b, linked, same):
        """Smallest text reachable inside this piece of work."""
        top = np.iinfo(np.int64).max
        while True:
            before = root.copy()
            root[a] = np.minimum(root[a], np.where(linked, root[b][None, :], top).min(axis=1))
            root[b] = np.minimum(root[b], np.where(linked, root[a][:, None], top).min(axis=0))
            if (root == before).all():
                return root

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams, piece, held = Grams(n), None, ([], [], [], [])
        for batch in batches:
            for group, i, j, block, text_id, weight, text in zip(*[batch[c] for c in PIECE], strict=True):
                if (group, i, j) != piece:
                    if piece is not None and len(held[0]) > 1:
                        yield results(piece, *held, grams)
                    piece, held = (group, i, j), ([], [], [], [])
                for column, value in zip(held, (text, block, weight, text_id), strict=True):
                    column.append(value)
        if piece is not None and len(held[0]) > 1:
            yield results(piece, *held, grams)

    return verify


PIECE = ["group", "i", "j", "block", "text_id", "weight", "text"]


def ngram_join(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = N, threshold: float = THRESHOLD, recall: float = RECALL, rows: int = ROWS
) -> DataFrame:
    """One row for each distinct (document, words): ``doc_id``, ``class_id``, ``n_links``, ``kept``, ``digest``.

    ``class_id`` is the smallest document of the class, reached over links; ``n_links`` the number of
    other documents linked directly, copies included; ``kept`` marks the one document that stays.
    """
    docs = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), digest_of(F.col(text)).alias("digest")
    )
    signed = written(signatures(docs, n, bands_for(threshold, rows, recall), rows), "signatures")

    # numbers of texts are made here and written down, so that they stay what they are
    items = signed.groupBy("doc_id", "digest").agg(F.max("grams").alias("grams"))
    texts = written(
        items.groupBy("digest")
        .agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("weight"), F.max("grams").alias("grams"))
        .withColumn("text_id", F.monotonically_increasing_id()),
        "texts",
    )
    one_each = texts.filter("grams > 0").select("text_id", "digest", "first_doc")
    of_first = F.col("doc_id").eqNullSafe(F.col("first_doc")) & (F.col("digest") == F.col("words"))
    band = (
        signed.select("digest", "doc_id", "keys")
        .join(one_each.withColumnRenamed("digest", "words"), of_first)
        .select("text_id", F.explode(F.array_distinct("keys")).alias("key"))
    )
    band = written(band.distinct(), "bands")
    heads = band.groupBy("key").agg(F.min("text_id").alias("head"), F.max("text_id").alias("last")).filter("head < last")
    edges = band.join(heads, "key").filter("text_id <> head").select("text_id", "head").distinct()
    groups = components(edges, "text_id", "head")

    linked = _verified(docs, texts, groups, n, threshold)
    return _classes(signed, texts, linked)


def _verified(docs: DataFrame, texts: DataFrame, groups: DataFrame, n: int, threshold: float) -> DataFrame:
    """``(text_id, links, root)``, one row for each text and piece of work it took part in."""
    sizes = groups.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    placed = (
        groups.join(sizes, "component")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    )
    candidates = written(
        placed.join(texts.select(F.col("text_id").alias("node"), "digest", "first_doc", "weight"), "node"), "candidates"
    )
    # read again only what is a candidate; a text's first document stands for its copies. Candidates grow
    # with the corpus, so both sides are sorted at any size instead of being broadcast while they are few
    first = candidates.withColumnsRenamed({"first_doc": "wanted", "digest": "words", "node": "text_id"})
    again = docs.join(first.hint("merge"), F.col("doc_id").eqNullSafe(F.col("wanted")) & (F.col("digest") == F.col("words")))
    once = again.select("text_id", "weight", "component", "blocks", "block", "text").dropDuplicates(["text_id"])
    pieces = once.select(
        F.col("component").alias("group"),
        F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.struct(F.least(other, "block").alias("i"), F.greatest(other, "block").alias("j")))).alias("p"),
        "block",
        "text_id",
        "weight",
        "text",
    ).select("group", "p.i", "p.j", "block", "text_id", "weight", "text")
    parted = pieces.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j", "text_id")
    return written(parted.mapInPandas(verifier(n, threshold), "text_id long, links long, root long"), "links")


def _classes(signed: DataFrame, texts: DataFrame, linked: DataFrame) -> DataFrame:
    across = linked.filter("root <> text_id").select("text_id", "root")
    classes = components(across, "text_id", "root").withColumnRenamed("node", "text_id")
    counts = linked.groupBy("text_id").agg(F.sum("links").alias("links"))
    texts = (
        texts.join(counts, "text_id", "left")
        .join(classes, "text_id", "left")
        .withColumn("component", F.coalesce("component", "text_id"))
    )
    texts = written(texts, "classes")
    # a class is named after its smallest document, not after its smallest text
    first = F.struct(F.col("first_doc").isNull().alias("unnumbered"), "first_doc", "text_id")
    names = texts.groupBy("component").agg(F.min(first).alias("top")).select("component", F.col("top.first_doc").alias("class_id"), F.col("top.text_id").alias("top_text"))
    texts = texts.join(names, "component")
    rows = signed.select("doc_id", "digest").distinct()
    blank = F.col("grams") == 0
    return rows.join(texts, "digest").select(
        "doc_id",
        F.when(blank, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(blank, 0).otherwise(F.coalesce("links", F.lit(0)) + F.col("weight") - 1).cast("long").alias("n_links"),
        (blank | ((F.col("text_id") == F.col("top_text")) & F.col("doc_id").eqNullSafe(F.col("class_id")))).alias("kept"),
        "digest",
    )


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The one document that stays of each class, with all its columns; the rest of its class goes.

    A row that repeats another's number and words is a copy like any other, so one of them stays.
    """
    names = docs.columns
    number, words = f"__d{names.index(doc_id)}", f"__d{names.index(text)}"
    rows = docs.toDF(*[f"__d{i}" for i in range(len(names))])
    rows = rows.withColumns({"__number": F.col(number).cast("long"), "__words": digest_of(F.col(words))})
    result = ngram_join(docs, doc_id, text)

    def same(frame: DataFrame):
        return rows["__number"].eqNullSafe(frame["doc_id"]) & (rows["__words"] == frame["digest"])

    gone = written(result.filter(~F.col("kept")).select("doc_id", "digest"), "copies")
    # rows alike in number and words are rare; only they are shuffled
    slim = rows.select(F.col("__number").alias("doc_id"), F.col("__words").alias("digest"))
    alike = written(slim.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "repeats")
    left = rows.join(gone, same(gone), "left_anti")
    if not alike.isEmpty():
        repeats = left.join(alike, same(alike), "left_semi").dropDuplicates(["__number", "__words"])
        left = left.join(alike, same(alike), "left_anti").union(repeats)
    return left.select(*[F.col(f"__d{i}").alias(name) for i, name in enumerate(names)])
