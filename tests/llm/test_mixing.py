from collections import Counter, defaultdict

from llm.corpus import AWKWARD, prose

from touchline.llm import mixing as m
from touchline.llm.ngram_join import split_words


def water(sizes, weights, total, cap):
    """Shares a total by weight, resharing what is above a source's cap, until none is above."""
    targets, free, left = {}, set(sizes), total
    while free:
        whole = sum(weights[s] for s in free)
        above = [s for s in free if left * weights[s] / whole > cap * sizes[s]]
        if not above:
            targets |= {s: left * weights[s] / whole for s in free}
            break
        for s in above:
            targets[s] = cap * sizes[s]
            free.discard(s)
        left = total - sum(targets.values())
    return targets


def corpus():
    return [(i, prose(i, 1 + i % 37), f"s{i % 3 if i % 2 else 9}") for i in range(900)]


def test_targets_and_what_is_taken(docs, monkeypatch):
    monkeypatch.setattr(m, "CELL_ROWS", 20)
    data = corpus() + [(*row, None) for row in AWKWARD]
    rows = m.mixed(docs(data)).collect()
    size = Counter()
    for _, text, source in data:
        size[source] += len(split_words(text))
    order = sorted(size, key=lambda s: (s is None, s))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    targets = water(size, weights, 1.5 * sum(size.values()), 2)
    assert len(rows) == len(data)
    taken, largest = Counter(), Counter()
    for r in rows:
        assert abs(r.target - targets[r.source]) < 1e-6 and r.source_size == size[r.source]
        assert r.taken == r.times * r.size <= 2 * r.size and len(r.positions) == r.times
        assert all(0 <= p <= 1 for p in r.positions) and list(r.positions) == sorted(r.positions)
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in order:
        assert abs(taken[s] - targets[s]) <= largest[s]


def test_positions_follow_the_schedules(docs):
    """What a source has been asked for at a time is the integral of its weights."""
    rows = m.mixed(docs(corpus())).collect()
    placed = defaultdict(list)
    for r in rows:
        for p in r.positions:
            placed[r.source].append((p, r.size))
    for number, source in enumerate(sorted(placed)):
        knots = m.Mixture().schedules[number % 3]
        whole = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:], strict=False))
        total = sum(size for _, size in placed[source])
        for time in (0.25, 0.5, 0.9):
            area = 0.0
            for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
                end = min(time, t1)
                if end > t0:
                    at_end = w0 + (w1 - w0) * (end - t0) / (t1 - t0)
                    area += (end - t0) * (w0 + at_end) / 2
            seen = sum(size for p, size in placed[source] if p <= time)
            assert abs(seen / total - area / whole) < 0.03


def test_reruns_agree_and_training_order_is_sorted(docs):
    df = docs(corpus())
    one, two = (sorted((r.doc_id, r.taken, tuple(r.positions)) for r in m.mixed(frame).collect()) for frame in (df, df.repartition(7)))
    assert one == two
    order = [(p, i) for i, _, positions in one for p in positions]
    used = m.training_order(df)
    assert used.columns == df.columns and [r.doc_id for r in used.collect()] == [i for _, i in sorted(order)]


def test_empty(docs):
    assert m.mixture(docs([])).count() == 0
    nothing = m.mixture(docs([(1, None), (2, "")])).collect()
    assert [(r.doc_id, r.taken) for r in nothing] == [(1, 0), (2, 0)]


SHAPE = "doc_id long, text string, source string, extra map<string, int>, place long, times int, positions int"


def test_training_order_of_awkward_rows(spark):
    """NULLs, empty texts, repeated rows, rows alike in number or text only, and columns the operator names itself."""
    data = [(i, t, s) for s in ("a", None) for i, t in AWKWARD] + [(9, "one two three", "a")] * 7 + [(None, None, None)] * 2
    data += [(9, "one two three", "b"), (10, "one two three", "a"), (None, "one two three", "a")]
    full = [(*row, {"k": n % 2}, 1, 2, 3) for n, row in enumerate(data)]
    df = spark.createDataFrame(full, SHAPE)
    used = m.training_order(df.repartition(5))
    assert used.columns == df.columns
    plain = lambda r: (r.doc_id, r.text, r.source, str(r.extra), r.place, r.times, r.positions)
    want, rows = Counter(), df.collect()
    mixed = m.mixed(df.withColumn("tag", m.F.struct("doc_id", "text", "source", "place")), carry=["tag", "extra"]).collect()
    for r in mixed:
        want[r.tag.doc_id, r.tag.text, r.tag.source, str(r.extra), 1, 2, 3] += r.times
    assert Counter(map(plain, used.collect())) == +want
    assert set(map(plain, rows)) >= set(want)
    assert m.training_order(df.limit(0)).count() == 0
    assert m.training_order(df.filter("text IS NULL")).count() == 0
