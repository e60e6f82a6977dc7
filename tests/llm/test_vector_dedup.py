from collections import Counter

import numpy as np

from touchline.llm import vector_dedup as v

COLUMNS = "vec_id long, embedding array<float>, label int, cell int, item string"


def plain(data, threshold=0.98):
    usable = [
        i for i, (n, e, label) in enumerate(data)
        if n is not None and e is not None and label is not None and all(x is not None and np.isfinite(x) for x in e) and any(e)
    ]
    unit = {i: np.array(data[i][1], dtype=np.float32).astype(float) for i in usable}
    unit = {i: x / np.sqrt(x @ x) for i, x in unit.items()}
    links, parent = Counter(), list(range(len(data)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, a in enumerate(usable):
        for b in usable[:k]:
            if data[a][2] == data[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                links[a] += 1
                links[b] += 1
                x, y = sorted((top(a), top(b)), key=lambda i: data[i][0])
                parent[y] = x
    return Counter((n, links[i], data[top(i)][0]) for i, (n, _, _) in enumerate(data))


def made(spark, data):
    return spark.createDataFrame([(n, e, label, 1, "x") for n, e, label in data], COLUMNS)


def found(df):
    rows = df.collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)
    return Counter((r.vec_id, r.n_links, r.component_id) for r in rows)


def corpus(n=60, seed=1):
    random, data = np.random.default_rng(seed), []
    for k in range(n):
        center = random.standard_normal(32)
        for _ in range(1 + k % 4):
            data.append((len(data) + 1, (center + random.standard_normal(32) * random.choice([0, 0.05, 0.12, 0.2])).astype(np.float32).tolist(), k % 3))
    return data


def awkward():
    one = [1.0, 2.0, 3.0]
    return [
        (9001, None, 1), (9002, [0.0, 0.0], 1), (9003, [float("nan"), 1.0], 1), (9004, [float("inf"), 1.0], 1), (9005, [None, 1.0], 1),
        (9006, one, None), (9007, one, 7), (9008, one, 7), (9008, one, 7), (9009, [2.0, 4.0, 6.0], 7), (9010, [1.0, 2.0], 7), (9011, [1e-30, 2e-30, 3e-30], 7), (9012, [], 1),
    ]


def test_against_all_pairs(spark):
    data = corpus() + awkward()
    assert found(v.vector_links(made(spark, data))) == plain(data)


def test_many_cells_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(v, "CELL", 8)
    data = corpus(200, 3) + [(5000 + i, x, 0) for i, x in enumerate([corpus(1, 9)[0][1]] * 50)]
    assert found(v.vector_links(made(spark, data))) == plain(data)


def test_empty_and_unnumbered(spark):
    assert v.vector_links(made(spark, [])).count() == 0
    rows = v.vector_links(made(spark, [(None, [1.0], 1), (2, [1.0], 1)])).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id) for r in rows) == [(0, 0, None), (2, 0, 2)]


def test_plan_is_calibrated():
    """Pairs just at the threshold meet often enough, and in some table's cell, about always."""
    plan = v.planned(0.98, 0.99999, 100_000)
    random = np.random.default_rng(4)
    a = random.standard_normal((4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = random.standard_normal((4000, 64))
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.98 * a + np.sqrt(1 - 0.98**2) * side
    met = np.array([v._met(a[i : i + 1], b[i : i + 1], plan)[0, 0] for i in range(400)])
    assert (met >= plan.collisions).mean() > 0.99
    together = np.zeros(4000, dtype=bool)
    for table in range(plan.tables):
        normals = v._normals(table + 1, plan.signs, 64)
        together |= ((a @ normals > 0) == (b @ normals > 0)).all(axis=1)
    assert together.mean() > 0.999


def test_counts_of_windows():
    random, plan = np.random.default_rng(5), v.planned(0.98, 0.999, 10)
    a, b = random.standard_normal((9, 16)) / 4, random.standard_normal((7, 16)) / 4
    lines = v._normals(0, plan.lines, 16)
    want = (np.abs((a @ lines)[:, None] - (b @ lines)[None]) <= plan.window).sum(axis=2)
    assert (v._met(a, b, plan) == want).all()
