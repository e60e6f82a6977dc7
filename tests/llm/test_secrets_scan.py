import random
import re
import time
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st
from llm.corpus import AWKWARD

from touchline.llm import secrets_scan as s

BASE = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    "access": re.compile("AKIA[A-Z0-9]+"),
    "hex": re.compile("[0-9a-f]+"),
}
HOLDS = {"assign": lambda m: len(m.group(2)) >= 6, "access": lambda m: len(m.group()) >= 20, "hex": lambda m: len(m.group()) >= 24}


def plain(text):
    return sorted((m.start(), i, m.end()) for i, k in enumerate(BASE) for m in BASE[k].finditer(text or "") if HOLDS[k](m))


SCANNER = s.Scanner()
PARTS = st.sampled_from(["password", "API_Key", "token", "secret", "AKIA", "akia", "=", ": ", "'", '"', " ", "a1b2c3d4e5f6", "0" * 11, "f", "Z9", "é", "K", "ſecret", "\n"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PARTS, max_size=14).map("".join))
def test_base_kinds_against_whole_text_patterns(text):
    assert [x for x in SCANNER.spans(text) if x[1] < 3] == plain(text)


def test_hexadecimal_runs_at_all_places():
    for n in range(20, 60):
        for lead in range(14):
            for end in ("", "g", "é"):
                text = "x" * lead + "a" * n + end
                assert [x for x in SCANNER.spans(text) if x[1] == 2] == [x for x in plain(text) if x[1] == 2]


def test_checksums():
    random.seed(3)
    body = "".join(random.choice(s.BASE62) for _ in range(30))
    good = body + s._base62(zlib.crc32(body.encode()), 6)
    wrong = good[:-1] + ("A" if good[-1] != "A" else "B")
    names = lambda text: [s.KINDS[k].name for _, k, _ in SCANNER.spans(text)]
    assert names(f"x ghp_{good} y") == ["hosted_git"] and names(f"ghp_{wrong}") == []
    assert names(f"npm_{good}") == ["package_registry"] and names(f"npm_{wrong}") == []
    token = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiJ4In0.c2ln"
    assert names(f"use {token}.") == ["web_token"] and names("eyJ9.eyJ9.x") == []


def test_long_runs_of_a_keyword():
    """1 MB of them takes well under a second, and a token that ends such a run is found as by the pattern alone."""
    token = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiJ4In0.c2ln"
    for text in ("eyJ" * 350_000, "eyJ." * 260_000, "eyJ" * 350_000 + ". " + token, "ghp_" * 250_000, "password" * 130_000, "-----BEGIN A " * 80_000):
        started = time.perf_counter()
        found = SCANNER.spans(text)
        assert time.perf_counter() - started < 5
        assert [x for x in found if x[1] == 5] == ([(len(text) - len(token), 5, len(text))] if text.endswith(token) else [])


def test_rows(docs):
    data = [*AWKWARD, (9, "My PASSWORD = 'abcdefg' and " + "AKIA" + "Z" * 16)]
    found = {(r.doc_id, tuple((x.kind, x.start, x.stop) for x in r.spans)) for r in s.secrets(docs(data)).collect()}
    assert (9, (("assign", 3, 22), ("access", 28, 48))) in found
    assert s.secrets(docs(data)).count() == len(data) and s.secrets(docs([])).count() == 0
