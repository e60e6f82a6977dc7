"""Embedding whitening with eigenvectors by QDWH spectral divide and conquer.

1. *Fit.* One pass gives the number of vectors, the sum and the range of each dimension, all in whole
   numbers; a second one the products of the vectors centred at the whole number next to their mean. What
   the whole number is off the mean is taken out exactly afterwards, so the covariance is right to the last bit.
2. *Components.* The polar factor of ``V - s I`` has eigenvalues +1 for eigenvalues of ``V`` above the shift
   ``s`` and -1 below it, so ``(U + I) / 2`` projects on the subspace of the upper ones. The factor comes from the
   dynamically weighted Halley iteration in its inverse-free QR form. The subspaces' bases split ``V`` into two smaller
   blocks, which are split in the same way until each holds one eigenvalue, or equal ones.
3. *Whitening.* The few components and scales are sent to all tasks, which project their vectors.

Only a matrix of dimensions x dimensions is on the driver, and its size does not depend on the number of vectors;
its products are summed in Spark. A covariance is a bounded thing to send around: ``MAX_DIMS`` limits it to 128 MB.

Rows whose vector is NULL or empty or holds a NULL or non-finite entry are left out, and so are rows whose vector has
not the length that most of the vectors have (of equally frequent lengths the larger). Rows with equal or NULL
numbers count each on their own. Entries beyond 2^52 / 1024 count as that. A component along which the vectors do
not vary - all of them equal, or fewer vectors than dimensions - has no scale: ``whitened`` is 0 there, and such components
do not count for ``identity_error``. A table without usable vectors gives no rows. ``deviation`` is NULL should it pass
64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from touchline.llm.words import written

COMPONENTS = 8
MAX_DIMS = 4096
SCALE, SHIFT = 1024, 100_000
BOUND = float(1 << 52)

_EPS = np.finfo(np.float64).eps


# --- eigenvectors ----------------------------------------------------------------------------


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by QDWH in its QR form."""
    size = len(a)
    norm = np.linalg.norm(a)
    if norm == 0:
        return np.eye(size)
    x = a / norm
    low = _EPS  # a lower bound of the smallest singular value; too low a bound only costs an iteration or two
    for _ in range(40):
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square)) if low < 1 else 0.0
        root = np.sqrt(1 + d)
        weight = root + np.sqrt(max(8 - 4 * d + 8 * (2 - square) / (square * root), 0.0)) / 2
        b = (weight - 1) ** 2 / 4
        c = weight + b - 1
        # x (weight + b x'x) (1 + c x'x)^-1 without an inverse
        q = np.linalg.qr(np.vstack([np.sqrt(c) * x, np.eye(size)]))[0]
        fresh = b / c * x + (weight - b / c) / np.sqrt(c) * q[:size] @ q[size:].T
        fresh = (fresh + fresh.T) / 2
        low = min(1.0, low * (weight + b * square) / (1 + c * square))
        moved = np.linalg.norm(fresh - x)
        x = fresh
        if moved <= 10 * size * _EPS or (1 - low <= 10 * _EPS and moved <= np.cbrt(_EPS) / 10):
            break
    return x


def _basis(projector: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Bases of the range of a projector and of what is orthogonal to it."""
    start = np.random.Generator(np.random.PCG64([12, len(projector), rank])).standard_normal((len(projector), rank))
    upper = np.linalg.qr(projector @ (projector @ start))[0]
    # the rest of a complete basis; once more, so that both are orthogonal to rounding
    whole = np.linalg.qr(np.hstack([upper, np.eye(len(projector)) - projector]), mode="reduced")[0]
    return whole[:, :rank], whole[:, rank:]


def _shifts(a: np.ndarray) -> Iterator[float]:
    """Places to split a spectrum at: the middle of the diagonal first, then others between its bounds."""
    diagonal = np.sort(np.diag(a))
    yield float(np.median(diagonal))
    yield float(diagonal.mean())
    radius = np.abs(a).sum(axis=1) - np.abs(np.diag(a))
    low, high = float((np.diag(a) - radius).min()), float((np.diag(a) + radius).max())
    for k in range(1, 9):
        for odd in range(1, 1 << k, 2):
            yield low + (high - low) * odd / (1 << k)


def spectral_bases(a: np.ndarray, scale: float) -> np.ndarray:
    """Orthonormal columns that make ``a`` diagonal, by splitting its spectrum again and again."""
    size = len(a)
    if size == 1:
        return np.ones((1, 1))
    off = a - np.diag(np.diag(a))
    if np.linalg.norm(off) <= size * _EPS * scale:
        return np.eye(size)
    for shift in _shifts(a):
        projector = (polar_factor(a - shift * np.eye(size)) + np.eye(size)) / 2
        trace = float(np.trace(projector))
        rank = round(trace)
        if not 0 < rank < size or abs(trace - rank) > 0.01:
            continue
        upper, lower = _basis(projector, rank)
        if np.linalg.norm(upper.T @ a @ lower) > 1e3 * size * _EPS * scale:
            continue  # an eigenvalue lies too near the shift
        parts = []
        for basis in (upper, lower):
            block = basis.T @ a @ basis
            parts.append(basis @ spectral_bases((block + block.T) / 2, scale))
        return np.hstack(parts)
    # no shift between the bounds splits it: all eigenvalues are equal to rounding
    return np.eye(size)


def components_of(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors in columns, their largest entry positive."""
    a = (covariance + covariance.T) / 2
    vectors = spectral_bases(a, max(float(np.linalg.norm(a)), np.finfo(np.float64).tiny))
    # splits leave rounding behind; one step of Newton's iteration restores lengths and right angles
    vectors = vectors @ (1.5 * np.eye(len(a)) - 0.5 * vectors.T @ vectors)
    vectors = vectors / np.sqrt((vectors * vectors).sum(axis=0))
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    values, vectors = values[order], vectors[:, order]
    top = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.where(vectors[top, np.arange(len(a))] < 0, -1.0, 1.0)


# --- fit -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Fit:
    """What a fit list of ``n`` vectors tells: sums and covariance, and its components."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @property
    def varying(self) -> np.ndarray:
        """Which components have any variance beyond rounding."""
        return self.values > len(self.values) * 100 * _EPS * max(float(self.values[0]), 0.0)


def _whole(column: pa.ListArray, dims: int) -> np.ndarray:
    """Vectors of the batch as whole numbers, one row each."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    return np.floor(np.clip(SCALE * flat, -BOUND, BOUND)).astype(np.int64) + SHIFT


def _usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast("array<double>").alias("vector"))
    return rows.filter(F.coalesce(sound, F.lit(False)) & (F.size("vector") > 0))


def _sums(rows: DataFrame, dims: int) -> tuple[list[int], list[int], list[int]]:
    """Sum, least and greatest entry of each dimension, combined in the tasks first."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, low, high = [0] * dims, [None] * dims, [None] * dims
        for batch in batches:
            if not len(batch):
                continue
            x = _whole(batch.column(0), dims)
            # halves of 32 bits, whose sums cannot overflow
            sums = [(int(a) << 32) + int(b) for a, b in zip((x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0), strict=True)]
            total = [a + b for a, b in zip(total, sums, strict=True)]
            low = [b if a is None else min(a, b) for a, b in zip(low, x.min(axis=0).tolist(), strict=True)]
            high = [b if a is None else max(a, b) for a, b in zip(high, x.max(axis=0).tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dims), pa.int32()), pa.array([str(t) for t in total]), pa.array(low, pa.int64()), pa.array(high, pa.int64())], names=["dim", "total", "low", "high"]
        )

    parts = rows.select("vector").mapInArrow(part, "dim int, total string, low long, high long")
    found = parts.groupBy("dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.min("low").alias("low"), F.max("high").alias("high"))
    ordered = sorted(found.collect(), key=lambda row: row["dim"])  # one row for each dimension
    return [int(r["total"]) for r in ordered], [r["low"] for r in ordered], [r["high"] for r in ordered]


def _products(rows: DataFrame, centre: list[int], reach: int) -> list[list[int]]:
    """Sums of products of entries less ``centre``, none of which is beyond ``reach``; exact."""
    dims = len(centre)
    fits = (1 << 53) // max(1, reach * reach)  # rows whose products sum exactly in doubles

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims), dtype=object)
        middle = np.array(centre, dtype=np.int64)
        for batch in batches:
            x = _whole(batch.column(0), dims) - middle if len(batch) else np.zeros((0, dims), dtype=np.int64)
            step = min(fits, 1 << 16)
            for low in range(0, len(x), step or 64):
                block = x[low : low + (step or 64)]
                if step:
                    block = block.astype(np.float64)
                    total += (block.T @ block).astype(np.int64).astype(object)
                else:
                    total += block.astype(object).T @ block.astype(object)
        for i in range(dims):
            yield pa.RecordBatch.from_arrays(
                [pa.array([i] * dims, pa.int32()), pa.array(range(dims), pa.int32()), pa.array([str(v) for v in total[i]])], names=["i", "j", "v"]
            )

    parts = rows.select("vector").mapInArrow(part, "i int, j int, v string")
    summed = parts.groupBy("i", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    out = [[0] * dims for _ in range(dims)]
    for row in summed.collect():  # dimensions x dimensions
        out[row["i"]][row["j"]] = int(row["v"])
    return out


def fitted(rows: DataFrame, dims: int, n: int) -> Fit:
    sums, lows, highs = _sums(rows, dims)
    centre = [(2 * s + n) // (2 * n) for s in sums]
    reach = max(max(h - c, c - low) for h, c, low in zip(highs, centre, lows, strict=True))
    products = _products(rows, centre, reach)
    off = [s - n * c for s, c in zip(sums, centre, strict=True)]
    # Python divides whole numbers of any length to the nearest double
    covariance = np.array([[(n * products[i][j] - off[i] * off[j]) / (n * n) for j in range(dims)] for i in range(dims)])
    return Fit(n, sums, covariance, *components_of(covariance))


# --- whitening -------------------------------------------------------------------------------


def _whitener(fit: Fit, count: int, schema: pa.Schema):
    """Projects batches of ``vec_id, vector``: adds the exact deviation and the whitened coordinates."""
    n, dims = fit.n, len(fit.sums)
    whole = [s // n for s in fit.sums]
    rest = np.array([s % n / n for s in fit.sums])  # what the mean is above its whole part
    scales = np.where(fit.varying[:count], 1 / np.sqrt(np.where(fit.varying[:count], fit.values[:count], 1.0)), 0.0)
    axes = fit.vectors[:, :count] * scales

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x = _whole(batch.column(1), dims)
            near = x - np.array(whole, dtype=np.int64)
            left = [s % n for s in fit.sums]
            if (n * (int(np.abs(near).max()) + 1)) ** 2 * dims < 1 << 63:
                z = n * near - np.array(left, dtype=np.int64)
                deviation = (z * z).sum(axis=1).tolist()
            else:
                z = n * near.astype(object) - np.array(left, dtype=object)
                deviation = [v if v < 1 << 63 else None for v in (z * z).sum(axis=1).tolist()]
            projected = (near - rest) @ axes
            lists = pa.FixedSizeListArray.from_arrays(pa.array(projected.ravel()), count).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviation, pa.int64()), lists], schema=schema)

    return run


def _identity_error(rows: DataFrame, varying: int) -> float:
    """The largest absolute entry of the covariance of the whitened coordinates minus the identity, over all rows."""
    at = [F.get("whitened", F.lit(k)) for k in range(varying)]
    means = rows.agg(*[F.avg(x).alias(f"m{k}") for k, x in enumerate(at)]).first()
    pairs = [(i, j) for i in range(varying) for j in range(i + 1)]
    sums = rows.agg(*[F.avg((at[i] - F.lit(means[i])) * (at[j] - F.lit(means[j]))).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(value - (i == j)) for value, (i, j) in zip(sums, pairs, strict=True))


def whitened(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each usable vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    ``deviation`` is the sum over dimensions of ``(n x - S)^2``, ``explained`` the component's share of all variance.
    """
    usable = _usable(vectors, vec_id, embedding)
    kind = dict(usable.dtypes)["vec_id"]
    lengths = usable.groupBy(F.size("vector").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.agg(F.max(F.struct("n", "dims"))).first()[0]
    if most is None:
        return usable.select("vec_id", *_columns(F.lit(None), F.lit(None), F.lit(None), F.lit(None), F.lit(None), F.lit(None))).limit(0)
    n, dims = most["n"], most["dims"]
    if dims > MAX_DIMS:
        raise ValueError(f"vectors of {dims} entries; at most {MAX_DIMS}")
    rows = usable.filter(F.size("vector") == dims)
    fit = fitted(rows, dims, n)
    count = min(components, dims)
    named = rows.select("vec_id", "vector")
    schema = f"vec_id {kind}, deviation long, whitened array<double>"
    arrow = pa.schema([("vec_id", to_arrow_type(named.schema["vec_id"].dataType)), ("deviation", pa.int64()), ("whitened", pa.list_(pa.float64()))])
    projected = written(named.mapInArrow(_whitener(fit, count, arrow), schema), "whitened")
    varying = int(fit.varying[:count].sum())
    error = _identity_error(projected, varying) if varying else 0.0
    trace = float(np.trace(fit.covariance))
    shares = [float(value / trace) if trace else 0.0 for value in fit.values[:count]]
    each = projected.select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened"))
    explained = F.get(F.array(*[F.lit(share) for share in shares]), F.col("k"))
    return each.select("vec_id", *_columns(F.col("k") + 1, F.lit(n), F.col("deviation"), F.col("whitened"), explained, F.lit(float(error))))


def _columns(component: Column, n: Column, deviation: Column, value: Column, explained: Column, error: Column) -> list[Column]:
    kinds = {"component": "int", "n": "long", "deviation": "long", "whitened": "double", "explained": "double", "identity_error": "double"}
    found = zip((component, n, deviation, value, explained, error), kinds.items(), strict=True)
    return [column.cast(kind).alias(name) for column, (name, kind) in found]
