"""Secrets in texts: a keyword automaton first, anchored patterns only where it hits, then checksums.

An Aho-Corasick automaton goes over each text once, whatever the number of keywords. A pattern
is only tried at the places its keyword was found, anchored there. Runs of hexadecimal digits have no
keyword; their prefilter looks at every twelfth character, since a run of 24 covers two of these.
Tokens that carry a checksum of themselves are reported only if it is right.

Places are code points, end exclusive. A NULL text is empty. Each row is looked at by itself: ties
and repeated rows come out as they went in, and a text of any length takes linear time.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: digits of the checksum in base 62.
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def _base62(number: int, width: int) -> str:
    out = ""
    while number:
        number, digit = divmod(number, 62)
        out = BASE62[digit] + out
    return out.rjust(width, "0")


def crc_suffix(match: re.Match) -> bool:
    """The last six characters are the CRC-32 of what stands between prefix and them, in base 62."""
    body = match.group(1)
    return _base62(zlib.crc32(body[:-6].encode()), 6) == body[-6:]


def web_token(match: re.Match) -> bool:
    """A signed web token: header and claims are JSON objects, and the header names an algorithm."""
    try:
        parts = [json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4))) for part in match.group().split(".")[:2]]
    except (ValueError, binascii.Error, UnicodeDecodeError, RecursionError):
        return False
    return all(isinstance(part, dict) for part in parts) and "alg" in parts[0]


@dataclass(frozen=True)
class Kind:
    """A pattern anchored at one of its keywords, and the test its matches have to pass."""

    name: str
    keywords: tuple[str, ...]
    pattern: str
    holds: Callable[[re.Match], bool]
    run: str = ""
    """A class of characters: where the pattern fails, it fails at all further keywords in the same run of these."""

    regex: re.Pattern = field(init=False)
    run_regex: re.Pattern | None = field(init=False)

    def __post_init__(self):
        object.__setattr__(self, "regex", re.compile(self.pattern, re.ASCII))
        object.__setattr__(self, "run_regex", re.compile(f"{self.run}+") if self.run else None)


# Keywords and forms of the kinds, the base ones first.
KINDS = (
    Kind(
        "assign",
        ("password", "passwd", "secret", "token", "apikey", "api_key"),
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        lambda match: len(match.group(1)) >= 6,
    ),
    Kind("access", ("akia",), r"AKIA[A-Z0-9]+", lambda match: len(match.group()) >= 20),
    Kind("hex", (), r"[0-9a-f]+", lambda match: len(match.group()) >= 24),
    Kind("hosted_git", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), r"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])", crc_suffix),
    Kind("package_registry", ("npm_",), r"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])", crc_suffix),
    Kind("web_token", ("eyj",), r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*", web_token, "[A-Za-z0-9_-]"),
    Kind("private_key", ("-----begin ",), r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", lambda match: True),
)
BASE = ("assign", "access", "hex")
_HEX_STEP = 12
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _automaton(kinds: tuple[Kind, ...]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    owners: dict[str, list[int]] = {}
    for number, kind in enumerate(kinds):
        for keyword in kind.keywords:
            owners.setdefault(keyword, []).append(number)
    for keyword, numbers in owners.items():
        found.add_word(keyword, (len(keyword), numbers))
    found.make_automaton()
    return found


_HEX = np.zeros(256, dtype=bool)
_HEX[np.frombuffer(b"0123456789abcdef", dtype=np.uint8)] = True


def _hex_hits(text: str, data: bytes) -> Iterator[int]:
    """Beginnings of the runs of hexadecimal digits that two probes in a row fall into."""
    if len(text) == len(data):
        probes = _HEX[np.frombuffer(data, dtype=np.uint8)[::_HEX_STEP]]
    else:
        codes = np.frombuffer(text[::_HEX_STEP].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        probes = (codes < 256) & _HEX[np.minimum(codes, 255).astype(np.uint8)]
    last = -1
    for probe in np.flatnonzero(probes[:-1] & probes[1:]):
        at = int(probe) * _HEX_STEP
        if at < last:
            continue
        while at > 0 and text[at - 1] in "0123456789abcdef":
            at -= 1
        yield at
        last = int(probe) * _HEX_STEP + 1
        while last < len(text) and text[last] in "0123456789abcdef":
            last += 1


class Scanner:
    def __init__(self, kinds: tuple[Kind, ...] = KINDS):
        self._kinds = kinds
        self._automaton = _automaton(kinds)
        self._unkeyed = [number for number, kind in enumerate(kinds) if not kind.keywords]

    def spans(self, text: str | None) -> list[tuple[int, int, int]]:
        """``(start, number of the kind, stop)``, sorted."""
        if not text:
            return []
        data = text.encode("utf-8", "surrogatepass")
        # only ASCII letters are folded, so places stay what they are
        folded = data.translate(_LOWER).decode("utf-8", "surrogatepass")
        hits: dict[int, list[int]] = {}
        for end, (size, numbers) in self._automaton.iter(folded):
            for number in numbers:
                hits.setdefault(number, []).append(end - size + 1)
        for number in self._unkeyed:
            hits[number] = list(_hex_hits(text, data))
        out = []
        for number, places in hits.items():
            kind, free = self._kinds[number], 0
            for place in sorted(places):
                # a match uses up its characters whether it holds or not
                if place < free:
                    continue
                if match := kind.regex.match(text, place):
                    free = match.end()
                    if kind.holds(match):
                        out.append((place, number, match.end()))
                elif kind.run_regex and (run := kind.run_regex.match(text, place)):
                    free = run.end()
        return sorted(out)


def secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: ``doc_id`` and ``spans``, ``array<struct<kind, start, stop>>`` by start, then kind."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner, names = Scanner(), [kind.name for kind in KINDS]
        for batch in batches:
            spans = [
                [{"kind": names[number], "start": start, "stop": stop} for start, number, stop in scanner.spans(text)] for text in batch["text"]
            ]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "spans": spans})

    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return slim.mapInPandas(scan, "doc_id long, spans array<struct<kind: string, start: bigint, stop: bigint>>")
