import random
import re
from collections import Counter, defaultdict

from llm.corpus import AWKWARD

from touchline.llm import collocations

SCHEMA = "doc_id long, text string, lang string, n int, phrase string, rank int"


def plain(data, least, longest=4, best=2000):
    """Every phrase of every length counted on its own."""
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang in data:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                for at in range(len(words) - k + 1):
                    counts[lang][tuple(words[at : at + k])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for phrase, a in candidates.items():
            longer = [
                b for p, b in candidates.items() if len(p) > len(phrase) and any(p[i : i + len(phrase)] == phrase for i in range(len(p) - len(phrase) + 1))
            ]
            if any(100 * b >= 80 * a for b in longer):
                continue
            score, _, left, right = min((2000000 * a // (f[phrase[:k]] + f[phrase[k:]]), k, f[phrase[:k]], f[phrase[k:]]) for k in range(1, len(phrase)))
            rows.append((-score, -a, " ".join(phrase).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def found(spark, data, **options):
    rows = spark.createDataFrame([(*row, 1, "p", 2) for row in data], SCHEMA)
    result = collocations.collocations(rows, **options)
    assert result.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(row) for row in result.collect())


def corpus(seed=3):
    pick = random.Random(seed)
    vocabulary = ["A", "b", "cd", "É", "é", "z-z", " ", "ﬀ", "x", "𝒳", "~"]
    data = []
    for n in range(300):
        words = [pick.choice(vocabulary[: 3 + n % 9]) for _ in range(pick.randrange(40))]
        words[5:5] = ["New", "York", "City", "hall"][: pick.randrange(5)]
        text = "".join(w + pick.choice([" ", " ", " ", "\t ", ". ", ",", "\n", "\x0b"]) for w in words)
        data.append((n, text, [None, "und", "en", "de"][n % 4]))
    return data + [(i, t, "en") for i, t in AWKWARD if t is None or len(t) < 5000]


def test_against_plain_counts(spark):
    data = corpus()
    for least in (2, 30):
        assert found(spark, data, least=least) == plain(data, least)


def test_best_only_and_other_lengths(spark):
    data = corpus(5)
    assert found(spark, data, least=3, best=7) == plain(data, 3, best=7)
    assert found(spark, data, least=3, longest=2) == plain(data, 3, longest=2)
    assert found(spark, data, least=3, longest=5) == plain(data, 3, longest=5)


def test_a_set_that_lets_all_pairs_pass(spark, monkeypatch):
    monkeypatch.setattr(collocations, "MOST_BITS", 64)
    data = corpus(6)
    assert found(spark, data, least=4) == plain(data, 4)


def test_no_phrases(spark):
    assert found(spark, []) == [] and found(spark, [(1, None, None), (2, " . ", "en"), (3, "once only", "en")]) == []


def test_a_long_text(spark):
    data = [(1, "over and out " * 20_000, "en")]
    assert found(spark, data) == plain(data, 30)
