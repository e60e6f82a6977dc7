import random
import re
from collections import Counter

from llm.corpus import AWKWARD, prose

from touchline.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for place, c in enumerate(reversed(digits)):
        n = int(c) * (1 + place % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def holds(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(part) <= 255 for part in value.split(".")),
        "card": lambda: 13 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 9 <= len(digits) <= 15,
    }[kind]()


def plain(text):
    return [(k, m.start(), m.end()) for k in BASE for m in re.finditer(BASE[k], text or "") if holds(k, m.group())]


def spans(row, name="spans"):
    return [(s.kind, s.start, s.stop) for s in row[name]]


def test_base_kinds_against_plain_patterns(docs):
    random.seed(5)
    parts = ["a.b", "x@y.z", "@", "c_d@e.f", "-", "+1", " (555) 010", "0", "255", "256", ".", "..", "4111 1111 1111 1111", "1.2.3.4", "é", "𐀀", "\n", " ", "000", "+4"]
    texts = ["".join(random.choice(parts) for _ in range(random.randrange(16))) for _ in range(400)]
    texts += ["1.2.3.4.5.6.7.8", "a@b.c_d@e.f", "1 2" * 3000, "+1 23 456 78 90 - ", "x" * 20_000 + "@", "9." * 5000]
    data = [*enumerate(texts, 100), *AWKWARD]
    rows = pii.personal_data(docs(data)).collect()
    assert Counter((r.doc_id, tuple(spans(r, "base"))) for r in rows) == Counter((i, tuple(plain(t))) for i, t in data)


def test_contexts_find_what_has_no_form_of_its_own(docs):
    known = [(i, f"{prose(i, 20)} account holder user{i}@mail.example.com {prose((i, 1), 9)}") for i in range(40)]
    unseen = [(1000 + i, f"{prose((i, 2), 20)} account holder DE{i:02}X77 {prose((i, 3), 9)}") for i in range(5)]
    plain_use = [(2000 + i, f"{prose((i, 4), 20)} chapter number {i} {prose((i, 5), 9)}") for i in range(40)]
    rows = {r.doc_id: spans(r) for r in pii.personal_data(docs(known + unseen + plain_use)).collect()}
    for i, text in unseen:
        at = text.index("DE")
        assert rows[i] == [("context", at, at + 7)]
    assert all(rows[i] == [] for i, _ in plain_use)
    assert all([k for k, *_ in rows[i]] == ["email"] for i, _ in known)


def test_words_that_anything_follows_are_no_pattern(docs):
    known = [(i, f"{prose(i, 20)} of the user{i}@mail.example.com of the dog of the cat of the house") for i in range(40)]
    other = [(1000 + i, f"{prose((i, 2), 20)} of the B{i}2") for i in range(5)]
    rows = {r.doc_id: spans(r) for r in pii.personal_data(docs(known + other)).collect()}
    assert all(rows[i] == [] for i, _ in other)


def test_redacted(docs):
    data = [(1, "é mail a@b.cd now 1.2.3.4"), (2, "nothing here"), (3, None), (4, "+1 555 010 9999"), *AWKWARD]
    df = docs(data)
    left = pii.redacted(df)
    texts = Counter((r.doc_id, r.text) for r in left.collect())
    assert left.columns == df.columns and sum(texts.values()) == len(data)
    assert texts[1, "é mail <EMAIL> now <IP>"] == 1 and texts[2, "nothing here"] == 1 and texts[3, None] == 1
    assert texts[4, "<PHONE>"] == 1


def test_empty(docs):
    assert pii.personal_data(docs([])).count() == 0 and pii.redacted(docs([])).count() == 0


def plain_contexts(data, settings=pii.Settings()):
    """The rounds of scoring on plain lists."""
    mentions, follows = [], Counter()
    for number, text in data:
        text = text or ""
        words = ["\x02", "\x02"]
        for m in re.finditer(r"[^\x20\x09-\x0D]+", text):
            context = " ".join(words[-2:])
            follows[context] += 1
            is_mention = re.search("[0-9@]", m.group()) is not None
            if is_mention:
                lead = re.match(r"[\"'(\[{<,;:]*", m.group()).group()
                core = re.sub(r"^[\"'(\[{<,;:]+|[\"')\]}>,;:.!?]+$", "", m.group())
                start = m.start() + len(lead)
                if core:
                    seed = any(a < start + len(core) and start < b for _, a, b in plain(text))
                    mentions.append((number, context, core, start, start + len(core), seed))
            words.append("\x01" if is_mention else m.group().lower())
    times, seeds, values = Counter(), {}, {}
    for _, context, core, _, _, seed in mentions:
        times[context, core] += 1
        seeds[core] = seeds.get(core, False) or seed
        values.setdefault(context, set()).add(core)
    values = {c: v for c, v in values.items() if len(v) >= settings.support}
    # only mentions met in such contexts take part
    part = {v for found in values.values() for v in found}
    seeds = {v: any(s for _, c, w, _, _, s in mentions if w == v and c in values) for v in part}
    score, patterns = {v: float(seeds[v]) for v in part}, {}
    while True:
        before = (len(patterns), sum(x > 0 for x in score.values()))
        patterns = {}
        for context, found in values.items():
            right = sum(times[context, v] * score[v] for v in found)
            sure = right / max(follows[context], right) if right else 0.0
            if sum(score[v] >= settings.accept for v in found) >= settings.support and sure >= settings.confidence:
                patterns[context] = sure
        for v in part:
            wrong = 1.0
            for context, sure in patterns.items():
                if v in values[context]:
                    wrong *= 1 - min(sure, 0.999999)
            by_pattern = 1 - wrong if any(v in values[c] for c in patterns) else 0.0
            score[v] = 1.0 if seeds[v] else by_pattern if by_pattern >= settings.accept else 0.0
        if before == (len(patterns), sum(x > 0 for x in score.values())):
            break
    out = {}
    for number, context, core, start, stop, _ in mentions:
        if context in patterns and core in part and not seeds[core] and score[core] > 0:
            base = plain(dict(data)[number] or "")
            if not any(a < stop and start < b for _, a, b in base):
                out.setdefault(number, set()).add(("context", start, stop))
    return {number: sorted(spans) for number, spans in out.items()}


def chains():
    """Records with one-word labels, text starts, wide padding and identifiers that lead to each other over many rounds."""
    data = [(i, f"{prose(i, 3)} holder user{i}@mail.example.com id K{i % 12} ref R{i} {prose((i, 1), 2)}") for i in range(60)]
    data += [(100 + i, f"Mail u{i}x@mail.example.com code K{i % 12}") for i in range(60)]
    data += [(200 + i, f"Mail v{i}@mail.example.com code w{i}@mail.example.com") for i in range(300)]
    for step in range(6):
        for i in range(12):
            low, high = (f"K{i}", f"L0x{i}") if step == 0 else (f"L{step - 1}x{i}", f"L{step}x{i}")
            data += [(1000 + 200 * step + 10 * i + n, f"step{'abcdefg'[step]} alpha {low} and stop") for n in range(9)]
            data.append((3000 + 20 * step + i, f"step{'abcdefg'[step]} alpha {high} and stop"))
    wide = f"key {'w' * 90}{' ' * 200}"
    data += [(4000 + i, f"{wide} user{i}q@mail.example.com") for i in range(6)] + [(4100 + i, f"{wide} QX{i}") for i in range(3)]
    return data + [(5000 + i, f"y{'x' * (i % 3)} {i} of 9 {prose((i, 8), 3)}") for i in range(30)]


def test_contexts_against_plain_rounds(docs):
    data = chains()
    want = plain_contexts(data)
    rows = {r.doc_id: [s for s in spans(r) if s[0] == "context"] for r in pii.personal_data(docs(data)).collect()}
    assert {number: found for number, found in rows.items() if found} == want
    # labels of one word after a mention; the last of a long chain; behind a long word and wide padding
    assert {0, 100, 3060, 4100} <= set(want) and 5000 not in want
