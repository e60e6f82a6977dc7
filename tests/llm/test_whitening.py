from fractions import Fraction
from math import floor, inf, nan

import numpy as np
import pytest

from touchline.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, vector string, component int, whitened double"


def frame(spark, data):
    return spark.createDataFrame([(i, v, 1, "x", 2, 0.5) for i, v in data], SCHEMA)


def random_vectors(n, dims, seed=1):
    rng = np.random.default_rng(seed)
    mixed = rng.standard_normal((n, dims)) @ rng.standard_normal((dims, dims)) * np.logspace(0, -2, dims) + rng.standard_normal(dims)
    return [(k, [float(np.float32(x)) for x in row]) for k, row in enumerate(mixed)]


def plain(data, components=8):
    """Sums in fractions, eigenvectors of numpy."""
    x = np.array([[floor(1024 * c) + 100000 for c in v] for _, v in data], dtype=object)
    n, dims = x.shape
    sums = x.sum(axis=0)
    deviation = [int(v) for v in ((n * x - sums) ** 2).sum(axis=1)]
    centred = np.array([[float(Fraction(int(n * a - s), n)) for a, s in zip(row, sums, strict=True)] for row in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    return n, deviation, centred @ vectors[:, :components] / np.sqrt(values[:components]), values / values.sum()


def check(rows, data, components=8):
    n, deviation, coordinates, shares = plain(data, components)
    at = {i: k for k, (i, _) in enumerate(data)}
    assert len(rows) == n * min(components, len(data[0][1]))
    got = np.zeros_like(coordinates)
    for r in rows:
        assert r.n == n and r.deviation == deviation[at[r.vec_id]]
        assert r.explained == pytest.approx(shares[r.component - 1], rel=1e-9)
        assert r.identity_error < 1e-8
        got[at[r.vec_id], r.component - 1] = r.whitened
    signs = np.sign((got * coordinates).sum(axis=0))
    assert np.abs(got - signs * coordinates).max() < 1e-7 * np.abs(coordinates).max()
    assert np.abs(np.cov(got.T, bias=True) - np.eye(got.shape[1])).max() < 1e-8


@pytest.mark.parametrize("dims", [2, 5, 24])
def test_against_exact_sums(spark, dims):
    data = random_vectors(300, dims)
    check(whitening.whitened(frame(spark, data).repartition(3)).collect(), data)


def test_what_is_left_out(spark):
    data = random_vectors(50, 4)
    awkward = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0]), (103, [nan, 1.0, 1.0, 1.0]), (104, [inf, 1.0, 1.0, 1.0]), (105, [1.0, 2.0])]
    check(whitening.whitened(frame(spark, data + awkward)).collect(), data)


def test_repeated_rows_and_rows_without_number(spark):
    data = random_vectors(30, 3)
    more = data + [(0, data[0][1]), (None, data[1][1]), (None, data[1][1])]
    rows = whitening.whitened(frame(spark, more)).collect()
    assert len(rows) == 33 * 3 and {r.n for r in rows} == {33}
    assert sum(r.vec_id is None for r in rows) == 6


def test_entries_far_apart(spark):
    """Beyond what 64 bits hold: still exact, and a deviation that does not fit is NULL."""
    data = [(k, [float((-1) ** k * 2.0**30 * (k + 1)), float(k % 3)]) for k in range(20)]
    rows = whitening.whitened(frame(spark, data)).collect()
    _, deviation, _, _ = plain(data)
    assert {r.vec_id: r.deviation for r in rows} == {k: d if d < 1 << 63 else None for k, d in enumerate(deviation)}
    assert all(r.identity_error < 1e-8 for r in rows)


def test_no_variance(spark):
    rows = whitening.whitened(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r.whitened, r.explained, r.identity_error, r.deviation) for r in rows] == [(0.0, 0.0, 0.0, 0)] * 4
    flat = whitening.whitened(frame(spark, [(k, [float(k), float(2 * k), 5.0]) for k in range(9)])).collect()
    assert {r.component for r in flat if r.whitened != 0} == {1} and all(r.identity_error < 1e-8 for r in flat)
    empty = whitening.whitened(frame(spark, [(1, None)]))
    assert empty.count() == 0
    assert empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


@pytest.mark.parametrize("dims", [1, 2, 7, 40])
def test_eigenvectors(dims):
    rng = np.random.default_rng(dims)
    q = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
    spectra = [np.logspace(0, -13, dims), np.repeat([5.0, 1.0], [dims // 2, dims - dims // 2]), np.ones(dims), np.zeros(dims), 1 + 1e-10 * np.arange(dims)]
    for spectrum in spectra:
        a = (q * spectrum) @ q.T
        values, vectors = whitening.components_of(a)
        norm = np.linalg.norm(a) or 1.0
        assert np.abs(values - np.sort(spectrum)[::-1]).max() < 1e-14 * dims * norm
        assert np.abs(a @ vectors - vectors * values).max() < 1e-13 * norm
        assert np.abs(vectors.T @ vectors - np.eye(dims)).max() < 1e-13


def test_polar_factor():
    rng = np.random.default_rng(3)
    a = rng.standard_normal((30, 30))
    u = whitening.polar_factor(a + a.T)
    assert np.abs(u @ u - np.eye(30)).max() < 1e-12
    h = u @ (a + a.T)
    assert np.abs(h - h.T).max() < 1e-11 and np.linalg.eigvalsh((h + h.T) / 2).min() > -1e-11
