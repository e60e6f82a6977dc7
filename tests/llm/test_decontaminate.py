import random
import re
from collections import Counter

import pytest
from llm.corpus import AWKWARD, prose

from touchline.llm import decontaminate

ITEMS = "item_id long, text string, doc_id int, words string, row int"


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain(data, items, width=10):
    """Every window of every item tried at every place."""
    windows = {}
    for name, text in items:
        own = words_of(text)
        size = min(width, len(own))
        for k in range(len(own) - size + 1 if own else 0):
            windows.setdefault(tuple(own[k : k + size]), set()).add("" if name is None else str(name))
    out = Counter()
    for number, text in data:
        own, hit, names = words_of(text), set(), set()
        for k in range(len(own)):
            for size in range(1, width + 1):
                found = windows.get(tuple(own[k : k + size])) if k + size <= len(own) else None
                if found:
                    hit.update(range(k, k + size))
                    names |= found
        out[number, len(own), len(hit), tuple(sorted(names)), bool(hit)] += 1
    return out


def found(spark, docs, data, items, **options):
    frame = spark.createDataFrame([(i, t, 1, "w", 2) for i, t in items], ITEMS)
    result = decontaminate.contamination(docs(data), frame, **options)
    return Counter((r.doc_id, r.n_words, r.n_hit, tuple(r.item_ids), r.contaminated) for r in result.collect() if r.n_items == len(r.item_ids))


def cases():
    items = [(k, prose(("item", k), 12 + k)) for k in range(12)]
    items += [(20, "Ten words are here, or more of them than ten."), (21, "two WORDS"), (22, None), (23, " .,! "), (24, items[3][1]), (None, prose("none", 11)), (25, "é" * 9)]
    items += [(26, "a a a a a a a a a a a a"), (26, prose("again", 15))]  # two rows, one item
    pick = random.Random(4)
    data = list(AWKWARD)
    for n in range(60):
        text = prose(("doc", n), pick.randrange(60)).split()
        own = words_of(items[pick.randrange(12)][1])
        low = pick.randrange(len(own))
        text[len(text) // 2 : len(text) // 2] = own[low : low + pick.randrange(1, 14)]
        data.append((n, " ".join(text).upper() if n % 3 else ", ".join(text)))
    data += [(70, items[0][1]), (71, items[0][1] + "!" + items[1][1]), (72, " ".join(["a"] * 30)), (73, "É éé two words É"), (74, "İTWO words TWO-WORDS ǅ"), (75, "é" * 9)]
    data += [(76, items[3][1]), (76, items[3][1]), (77, prose("none", 11)), (78, "two"), (79, " ".join(["a"] * 9))]
    return data, items


@pytest.mark.parametrize("options", [{}, {"shingle": 1}, {"width": 4, "shingle": 7}])
def test_against_all_windows(spark, docs, options):
    data, items = cases()
    assert found(spark, docs, data, items, **options) == plain(data, items, options.get("width", 10))


def test_common_shingles_and_a_full_bit_set(spark, docs, monkeypatch):
    """The same rows when the bits let everything pass."""
    from touchline.llm import words

    monkeypatch.setattr(words, "SET_BITS", 64)
    data, items = cases()
    data += [(100 + n, "a a a a a a a a a a " + items[5][1]) for n in range(40)]
    assert found(spark, docs, data, items) == plain(data, items)


def test_empty_tables(spark, docs):
    data = [(1, "some words"), (2, None)]
    assert found(spark, docs, data, []) == plain(data, [])
    assert found(spark, docs, data, [(1, None), (2, "")]) == plain(data, [])
    assert found(spark, docs, [], [(1, "some words")]) == Counter()


def test_clean(spark, docs):
    data, items = cases()
    frame = spark.createDataFrame([(i, t, 1, "w", 2) for i, t in items], ITEMS)
    left = decontaminate.clean(docs(data), frame)
    bad = {number for number, _, _, _, dirty in plain(data, items) if dirty}
    assert left.columns == docs([]).columns
    texts = {(i, t) for i, t in data if not next(iter(plain([(i, t)], items)))[4]}
    assert {(r.doc_id, r.text) for r in left.collect()} == texts and bad


def test_lower_case_of_ascii_only(spark):
    from pyspark.sql import functions as F

    from touchline.llm.words import lower_ascii

    texts = ["ABC xyz", "ÀB", "ǅA", "ⅧA", "ⒶA", "ß ẞA", "ΑΣ A", "İI", "éA", "", None, "ႠA", "ᲐA", "𐐀A"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    lowered = [None if t is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in texts]
    assert [r[0] for r in frame.select(lower_ascii(F.col("t"))).collect()] == lowered
