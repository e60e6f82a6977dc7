import random
import re
from collections import Counter

from llm.corpus import AWKWARD, prose

from touchline.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    """The base counts, the plain way."""
    words = WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside)


def rows_of(df):
    return [
        (r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words), r.base_failed, r.kept, r.posterior)
        for r in df.collect()
    ]


def test_base_counts(docs):
    random.seed(1)
    texts = [" ".join(random.choice("ab c# d\n é <x> \x0b 𝐀".split(" ")) for _ in range(random.randrange(60))) for _ in range(80)]
    data = [*enumerate(texts, 100), *AWKWARD]
    found = rows_of(q.quality(docs(data)))
    assert Counter((i, c) for i, c, *_ in found) == Counter((i, counts(t)) for i, t in data)
    for _, (n, _, _, _, repeated), failed, kept, _ in found:
        assert failed == (n < 10 or 100 * repeated > 20 * n) and not (kept and failed)


def test_empty(docs):
    assert q.quality(docs([])).count() == 0 and q.filtered(docs([])).count() == 0


def corpus():
    good = [(i, ". ".join(prose((i, k), 12) for k in range(8)) + " the of and.") for i in range(300)]
    symbols = [(1000 + i, "### ".join(prose((i, "s"), 90).split()) + "###") for i in range(20)]
    shouting = [(2000 + i, prose((i, "u"), 90).upper()) for i in range(20)]
    stutter = [(3000 + i, " ".join(w for w in prose((i, "t"), 60).split() for _ in range(2))) for i in range(20)]
    return good, symbols + shouting + stutter


def test_bad_kinds_are_told_apart_from_good(docs):
    good, bad = corpus()
    kept = {i for i, _, _, kept, _ in rows_of(q.quality(docs(good + bad))) if kept}
    assert kept == {i for i, _ in good}


def test_clean_corpus_stays(docs):
    good, _ = corpus()
    assert all(kept for *_, kept, _ in rows_of(q.quality(docs(good))))


def test_filtered_agrees_and_keeps_all_columns(docs):
    good, bad = corpus()
    df = docs(good + bad + AWKWARD)
    left = q.filtered(df)
    assert left.columns == df.columns
    kept = Counter(i for i, _, _, kept, _ in rows_of(q.quality(df)) if kept)
    assert Counter(r.doc_id for r in left.collect()) == kept


def expectation_maximisation(histogram, rules, tolerance):
    """The same estimate on plain lists: rows are votes and n."""
    import math

    first = q.first_model(rules)
    kinds, names = list(first.shares), first.rules
    shares, rejects = dict(first.shares), {k: dict(v) for k, v in first.rejects.items()}
    while True:
        before = (shares, {k: dict(v) for k, v in rejects.items()})
        rows = {k: 0.0 for k in kinds}
        voted, no = Counter(), Counter()
        for votes, n in histogram:
            logs = [
                math.log(shares[k])
                + sum(
                    math.log(rejects[k][r]) if v == q.REJECT else math.log(1 - rejects[k][r]) if v == q.KEEP else 0
                    for r, v in zip(names, votes, strict=True)
                )
                for k in kinds
            ]
            parts = [math.exp(x - max(logs)) for x in logs]
            for k, part in zip(kinds, parts, strict=True):
                weight = n * part / sum(parts)
                rows[k] += weight
                for r, v in zip(names, votes, strict=True):
                    voted[k, r] += weight * (v != q.ABSTAIN)
                    no[k, r] += weight * (v == q.REJECT)
        weights = {k: rows[k] + q.PSEUDO * first.shares[k] for k in kinds}
        shares = {k: weights[k] / sum(weights.values()) for k in kinds}
        for k in kinds:
            for r in names:
                rate = (no[k, r] + q.PSEUDO * q._start(k, r)) / (voted[k, r] + q.PSEUDO)
                rejects[k][r] = min(rate, q.MAX_FALSE_ALARM) if k == q.GOOD else max(rate, q.MIN_OWN) if k == r else rate
        moved = [abs(shares[k] - before[0][k]) for k in kinds] + [shares[k] * abs(rejects[k][r] - before[1][k][r]) for k in kinds for r in names]
        if max(moved) < tolerance:
            return shares, rejects


def test_estimate_against_plain_lists(spark):
    random.seed(2)
    rules = q.RULES[:4]
    names = [r.name for r in rules]
    found = Counter(tuple(random.choices([-1, 0, 1], weights=[1, 2, 9], k=4)) for _ in range(2000))
    frame = spark.createDataFrame([(*votes, n) for votes, n in found.items()], ", ".join(f"{n} int" for n in names) + ", n long")
    model = q.estimate(frame, rules, tolerance=0.0005)
    shares, rejects = expectation_maximisation(found.items(), rules, 0.0005)
    for k in shares:
        assert abs(model.shares[k] - shares[k]) < 1e-9
        assert all(abs(model.rejects[k][r] - rejects[k][r]) < 1e-9 for r in names)
