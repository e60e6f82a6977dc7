import random
from collections import Counter

import numpy as np
from llm.corpus import AWKWARD, prose

from touchline.llm import ngram_join as j


def plain(data, n=5, threshold=0.8):
    """Class, links and whether it stays, for every distinct (number, words)."""
    items = sorted({(i, tuple(j.split_words(t))) for i, t in data}, key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    sets = [{w[k : k + n] for k in range(max(1, len(w) - n + 1))} if w else set() for _, w in items]
    links, parent = Counter(), list(range(len(items)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(items)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 10 * both >= round(10 * threshold) * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return Counter((items[k][0], items[top(k)][0], links[k]) for k in range(len(items)))


def found(df):
    return Counter((r.doc_id, r.class_id, r.n_links) for r in df.collect())


def edited(text, share, seed):
    words, random_ = text.split(), random.Random(str(seed))
    return " ".join(prose((seed, k), 1) if random_.random() < share else w for k, w in enumerate(words))


def corpus():
    data = []
    for i in range(25):
        base = prose(i, 150)
        data += [(100 * i, base), (100 * i + 1, base), (100 * i + 2, base.replace(" ", "\n\t"))]
        data += [(100 * i + 10 + k, edited(base, 0.004 * (k + 1), (i, k))) for k in range(8)]
    return data


def test_against_all_pairs(docs):
    data = corpus() + AWKWARD
    result = j.ngram_join(docs(data))
    assert found(result) == plain(data)
    kept = [r for r in result.collect() if r.kept]
    blank = sum(1 for r in kept if r.class_id in (1, 2, 3))
    assert blank == 3 and len({r.class_id for r in kept}) == len(kept)


def test_blocks_give_the_same(docs, monkeypatch):
    data = corpus()[:99]
    monkeypatch.setattr(j, "BLOCK", 3)
    assert found(j.ngram_join(docs(data))) == plain(data)


def test_large_group_of_copies_and_near_copies(docs):
    base = prose("g", 400)
    data = [(i, base) for i in range(400)] + [(1000 + i, edited(base, 0.002, i)) for i in range(60)]
    assert found(j.ngram_join(docs(data))) == plain(data)


def test_empty(docs):
    assert j.ngram_join(docs([])).count() == 0 and j.deduplicated(docs([])).count() == 0


def test_deduplicated_keeps_one_row_of_each_class(docs):
    data = corpus() + AWKWARD
    df = docs(data)
    left = j.deduplicated(df)
    classes = {(i, c) for i, c, _ in found(j.ngram_join(df))}
    rows = left.collect()
    assert left.columns == df.columns and len(rows) == len({c for _, c in classes})
    assert Counter(r.doc_id for r in rows) == Counter({c for _, c in classes})


def test_bands_reach_the_recall():
    for rows in (4, 6, 8):
        bands = j.bands_for(0.8, rows, 0.999)
        assert 1 - (1 - 0.8**rows) ** bands >= 0.999 > 1 - (1 - 0.8**rows) ** (bands - 1)


def test_comparison_of_sets():
    random_ = np.random.default_rng(1)
    sets = [np.unique(random_.integers(0, 40, 25).astype(np.uint64)) for _ in range(30)]
    got = j._compared(sets, sets, 0.5)
    for a in range(30):
        for b in range(30):
            x, y = set(sets[a]), set(sets[b])
            assert got[a, b] == (2 * len(x & y) >= len(x | y))
