"""Embedding near-duplicates: collision-counting projections, then cosine in double precision.

1. Equal vectors of a label are one *item* with a weight; a group of copies never meets itself.
2. Cells make the work subquadratic: the signs of a few projections name a cell, their number growing with the
   logarithm of the largest label, and enough independent tables of cells are made for the target recall.
3. In a cell, vectors are put on many lines, one for each projection, sorted on each, and a window
   around every vector is opened. Pairs that meet in at least ``collisions`` windows go on. The count is
   calibrated: the smallest one that a pair at the threshold reaches with the target recall.
4. What goes on is compared exactly. A pair met in several tables counts in the first of them only.

Cells too large for one task are cut into blocks, each pair of blocks a piece of work of bounded size.
Links are counted, not listed: a piece returns one row for each of its items, with the weight of its links and the
smallest item it reaches.

Vectors with a NULL or non-finite component, of length 0, NULL themselves, or without number or label link
with nothing and come out as a component of their own; vectors of different dimension are not compared.
Rows that repeat a number are separate vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.components import components
from touchline.llm.words import written

CELL = 512
"""Items aimed at in a cell, and the size of a block."""

_SEED = 6


@dataclass(frozen=True)
class Plan:
    """What the threshold, the recall and the size of the largest label ask for."""

    threshold: float
    signs: int
    tables: int
    lines: int
    window: float
    collisions: int


def planned(threshold: float, recall: float, largest: int, lines: int = 32) -> Plan:
    miss = (1 - recall) / 2  # half for the cells, half for the count
    angle = math.acos(threshold)
    signs = max(0, math.ceil(math.log2(max(1, largest) / CELL)))
    together = (1 - angle / math.pi) ** signs
    tables = 1 if signs == 0 else math.ceil(math.log(miss) / math.log(1 - together))
    distance = math.sqrt(2 - 2 * threshold)
    # two unit vectors at that distance differ on a line by a normal variable with this deviation
    window = 1.5 * distance
    meets = math.erf(1.5 / math.sqrt(2))
    tail, collisions = 0.0, 0
    for k in range(lines + 1):
        tail += math.comb(lines, k) * meets**k * (1 - meets) ** (lines - k)
        if tail > miss:
            collisions = k
            break
    return Plan(threshold, signs, tables, lines, window, collisions)


def _normals(salt: int, count: int, dims: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([_SEED, salt, dims])).standard_normal((dims, count))


def _unit(rows: pd.Series) -> np.ndarray:
    x = np.stack([np.asarray(row, dtype=np.float64) for row in rows])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def celled(plan: Plan):
    """Adds ``cells``, one number for each table, to rows with ``vector``."""

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cells = np.zeros((len(batch), plan.tables), dtype=np.int64)
            for dims, part in batch.groupby(batch["vector"].map(len)).groups.items() if len(batch) else ():
                at = batch.index.get_indexer(part)
                x = _unit(batch["vector"].iloc[at])
                for table in range(plan.tables if plan.signs else 0):
                    sides = x @ _normals(table + 1, plan.signs, dims) > 0
                    cells[at, table] = sides @ (1 << np.arange(plan.signs, dtype=np.int64))
            yield batch.assign(cells=list(cells))

    return assign


def _met(a: np.ndarray, b: np.ndarray, plan: Plan) -> np.ndarray:
    """For each pair, in how many windows it meets."""
    lines = _normals(0, plan.lines, a.shape[1])
    on_a, on_b = a @ lines, b @ lines
    met = np.zeros((len(a), len(b)), dtype=np.int16)
    row = np.arange(len(a))
    for line in range(plan.lines):
        order = np.argsort(on_b[:, line], kind="stable")
        values = on_b[order, line]
        edge = np.zeros((len(a), len(b) + 1), dtype=np.int8)
        edge[row, np.searchsorted(values, on_a[:, line] - plan.window, "left")] += 1
        edge[row, np.searchsorted(values, on_a[:, line] + plan.window, "right")] -= 1
        met[:, order] += np.cumsum(edge[:, :-1], axis=1, dtype=np.int8)
    return met


def linker(plan: Plan):
    """Counts the links inside each piece of work; rows of a piece come one after another."""

    def piece(key: tuple, rows: list[tuple]) -> pd.DataFrame:
        _, _, table, _, i, j = key
        blocks = np.array([row[0] for row in rows])
        ids, weights = np.array([row[1] for row in rows]), np.array([row[2] for row in rows])
        cells = np.array([row[3] for row in rows])
        vectors = _unit(pd.Series([row[4] for row in rows]))
        a = np.flatnonzero(blocks == i)
        b = a if i == j else np.flatnonzero(blocks == j)
        links, root = np.zeros(len(ids), dtype=np.int64), ids.copy()
        if len(a) and len(b):
            linked = _met(vectors[a], vectors[b], plan) >= plan.collisions
            linked &= vectors[a] @ vectors[b].T >= plan.threshold
            for earlier in range(table):
                linked &= cells[a, earlier][:, None] != cells[b, earlier][None, :]
            if i == j:
                np.fill_diagonal(linked, False)
            links[a] += linked @ weights[b]
            if i != j:
                links[b] += linked.T @ weights[a]
            top = np.iinfo(np.int64).max
            while True:
                before = root.copy()
                root[a] = np.minimum(root[a], np.where(linked, root[b][None, :], top).min(axis=1))
                root[b] = np.minimum(root[b], np.where(linked, root[a][:, None], top).min(axis=0))
                if (root == before).all():
                    break
        some = links > 0
        return pd.DataFrame({"item": ids[some], "links": links[some], "root": root[some]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, rows = None, []
        for batch in batches:
            for *key, block, item, weight, cells, vector in zip(*[batch[c] for c in PIECE], strict=True):
                if tuple(key) != current:
                    if len(rows) > 1:
                        yield piece(current, rows)
                    current, rows = tuple(key), []
                rows.append((block, item, weight, cells, vector))
        if len(rows) > 1:
            yield piece(current, rows)

    return run


_KEY = ["label", "dims", "table", "cell", "i", "j"]
PIECE = [*_KEY, "block", "item", "weight", "cells", "vector"]


def vector_links(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", threshold: float = 0.98, recall: float = 0.99999
) -> DataFrame:
    """One row for each row of ``vectors``: ``vec_id, n_links, component_id, kept``."""
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(sound, F.lit(False))
    rows = (
        vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(embedding).cast("array<double>").alias("vector"))
        .withColumn("usable", usable)
        .withColumns({"h1": F.xxhash64("label", "vector"), "h2": F.xxhash64(F.lit(2), "vector", "label")})
    )
    items = rows.filter("usable").groupBy("h1", "h2").agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"), F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("weight")
    )
    items = written(items.withColumns({"item": F.monotonically_increasing_id(), "dims": F.size("vector")}), "items")
    largest = items.groupBy("label", "dims").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    plan = planned(threshold, recall, largest or 0)
    linked = _linked(items, plan)

    counts = linked.groupBy("item").agg(F.sum("links").alias("links"))
    joined = components(linked.filter("root <> item").select("item", "root"), "item", "root").withColumnRenamed("node", "item")
    named = items.select("h1", "h2", "item", "first", "weight").join(counts, "item", "left").join(joined, "item", "left")
    named = written(named.withColumn("component", F.coalesce("component", "item")), "named")
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = named.join(smallest, "component").select("h1", "h2", "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    slim = rows.select("vec_id", "usable", "h1", "h2")
    out = slim.filter("usable").join(named, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = slim.filter(~F.col("usable")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _linked(items: DataFrame, plan: Plan) -> DataFrame:
    kind = dict(items.dtypes)["label"]
    celled_items = items.select("label", "dims", "item", "weight", "vector").mapInPandas(
        celled(plan), f"label {kind}, dims int, item long, weight long, vector array<double>, cells array<long>"
    )
    each = written(celled_items, "cells").select("*", F.posexplode("cells").alias("table", "cell"))
    address = ["label", "dims", "table", "cell"]
    sizes = each.groupBy(*address).agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    blocks = F.ceil(F.col("size") / CELL).cast("int")
    placed = each.join(sizes, address).withColumn("blocks", blocks)
    placed = placed.withColumn("block", F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int"))
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: F.struct(F.least(other, "block").alias("i"), F.greatest(other, "block").alias("j")))
    pieces = placed.withColumn("p", F.explode(meets)).select(*address, "p.i", "p.j", "block", "item", "weight", "cells", "vector")
    dealt = pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "item")
    return written(dealt.mapInPandas(linker(plan), "item long, links long, root long"), "links")
