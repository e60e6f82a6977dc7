from random import Random

import numpy as np
from llm.corpus import AWKWARD, prose

from touchline.llm import chunk_dedup as c


def found(df):
    return sorted((r.doc_id, r.start, r.stop, r.first_doc_id, r.n_spare_words) for r in df.collect())


def test_shared_passages_are_found_and_others_left(docs):
    passage = {k: prose(("p", k), 60) for k in range(30)}
    data = []
    for k in range(30):
        data += [(10 * k + i, f"{prose((k, i, 'a'), 40 + i)} é {passage[k]} {prose((k, i, 'b'), 30)}") for i in (1, 2, 3)]
        data.append((10 * k + 4, prose((k, "clean"), 120) + "\nAll rights reserved by nobody in particular."))
    texts = dict(data)
    rows = found(c.repeats(docs(data)))
    assert {i for i, *_ in rows} == {10 * k + i for k in range(30) for i in (1, 2, 3)}
    for i, start, stop, first, spare in rows:
        k = i // 10
        at = texts[i].index(f"é {passage[k]}")
        assert (start, stop) == (at, at + 2 + len(passage[k]))
        assert first == 10 * k + 1 and (spare == 0) == (i == first)


def test_cutting_out(docs):
    passage = prose("p", 100)
    data = [(11, f"{prose(1, 50)} {passage} {prose(2, 50)}"), (12, f"{prose(3, 50)} {passage} {prose(4, 50)}"), *AWKWARD]
    df = docs(data)
    left = {r.doc_id: r.text for r in c.without_repeats(df).collect()}
    assert c.without_repeats(df).columns == df.columns and left[11] == data[0][1]
    assert left[12] == f"{prose(3, 50)}  {prose(4, 50)}"


def common_stretches(texts, least):
    """By brute force: for each text the longest stretches of ``least`` words or more that another text has."""
    words = {i: text.split(" ") for i, text in texts.items()}
    homes = {}
    for i, own in words.items():
        for at in range(len(own) - least + 1):
            homes.setdefault(tuple(own[at : at + least]), set()).add(i)
    out = set()
    for i, own in words.items():
        hit = sorted({k for at in range(len(own) - least + 1) if len(homes[tuple(own[at : at + least])]) > 1 for k in range(at, at + least)})
        for k in hit:
            if k - 1 not in hit:
                last = next(m for m in range(k, len(own)) if m + 1 not in hit)
                start = len(" ".join(own[:k])) + (k > 0)
                out.add((i, start, start + len(" ".join(own[k : last + 1])), last + 1 - k))
    return out


def test_all_common_stretches(docs):
    random, texts = Random(3), {}
    for k in range(400):
        passage = prose(("q", k), random.choice([44, 49, 50, 51, 51, 51, 60, 90]))
        for i in range(random.choice([2, 2, 3, 7])):
            ends = [prose((k, i, side), random.randrange(40)) for side in "ab"]
            texts[10 * k + i] = f"{ends[0]} {passage} {ends[1]}".strip(" ")
    # of one passage others have the first half, the second half and the middle
    whole = prose("whole", 160)
    own = whole.split(" ")
    texts |= {9001: whole, 9002: " ".join(own[:70] + ["q1"]), 9003: " ".join(["q2"] + own[100:]), 9004: " ".join(["q3"] + own[40:125] + ["q4"])}
    rows = set()
    for r in c.repeats(docs(list(texts.items()))).collect():
        found = texts[r.doc_id][r.start : r.stop]  # may end in the blank that all copies have there
        start = r.start + len(found) - len(found.lstrip(" "))
        rows.add((r.doc_id, start, start + len(found.strip(" ")), r.n_words))
    expected = common_stretches(texts, c.MIN_WORDS)
    assert (rows - expected, expected - rows) == (set(), set())


def test_no_passage_of_51_words_lacks_an_anchor():
    """A chunk between cuts that do not depend on the surroundings; then the ends are found exactly."""
    gear, lost = c._gear(), 0
    for k in range(3000):
        random = Random(k)
        lead, passage, tail = (" ".join("".join(random.choices("etaoinshrdlu", k=random.choice([2, 3, 3, 4, 5, 6, 7, 9]))) for _ in range(n)) for n in (20, 51, 20))
        cuts = c.boundaries(np.frombuffer(f"{lead} {passage} {tail}".encode(), np.uint8), np.array([0]), gear)
        first, last = len(lead) + 1 + c._BEFORE, len(lead) + 1 + len(passage) - c._BEHIND
        lost += ((cuts >= first) & (cuts <= last)).sum() < 2
    assert lost == 0


def test_copies_and_repeated_rows(docs):
    text = prose("copy", 90)
    rows = found(c.repeats(docs([(1, text), (1, text), (2, text), (None, text), (3, "x " * 400), (4, None), (5, "")])))
    assert {i for i, *_ in rows} == {1, 2} and all(start == 0 and stop == len(text) for _, start, stop, *_ in rows)
    assert c.repeats(docs([])).count() == 0


def test_boundaries_do_not_move_with_insertions():
    gear, text = c._gear(), prose("b", 2000).encode()
    plain_cuts = c.boundaries(np.frombuffer(text, np.uint8), np.array([0]), gear)
    for lead in (1, 7, 100):
        moved = c.boundaries(np.frombuffer(b"q" * lead + text, np.uint8), np.array([0]), gear) - lead
        assert set(plain_cuts[plain_cuts > 60]) == set(moved[moved > 60])


def test_rolling_hash_against_its_sum():
    gear, data = c._gear(), np.random.default_rng(1).integers(0, 256, 300).astype(np.uint8)
    got = c.rolling(data, gear)
    for at in range(c.WINDOW - 1, 300):
        assert int(got[at]) == sum(int(gear[data[at - k]]) << k for k in range(c.WINDOW)) % 2**64


def test_chunks_cover_the_text_and_are_bounded():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 50, 500)
    for count in (1, 2, 5, 16, 20, 33):
        assert [min(values[max(0, i - count + 1) : i + 1]) for i in range(500)] == c.lowest(values, count).tolist()
    for text in ("é" * 5000, "ab" * 4000, prose(1, 900), "𐀀x" * 3000):
        data = np.frombuffer(text.encode(), np.uint8)
        cuts = c.boundaries(data, np.array([0]), c._gear())
        gaps = np.diff(np.append(cuts, len(data)))
        assert cuts[0] == 0 and gaps.max() <= c.LONGEST + 3 and ((data[cuts] & 0xC0) != 0x80).all()
