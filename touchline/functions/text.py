"""Text expressions."""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline.functions._columns import as_column


def code_to_words(code: Column | str) -> Column:
    """``IN_PLAY`` -> ``in play``."""
    return F.replace(F.lower(as_column(code).cast("string")), F.lit("_"), F.lit(" "))


def join_present(*parts: Column | str) -> Column:
    """Concatenate, skipping NULL parts (``F.concat`` gives NULL instead)."""
    return F.concat_ws("", *[as_column(part).cast("string") for part in parts])


def split_text(text: Column | str, separator: str) -> Column:
    """Split on a literal separator; empty pieces are kept."""
    return F.split(as_column(text), rf"\Q{separator}\E", -1)


@cache
def _accent_table() -> tuple[str, str]:
    """Letters that decompose into one base letter plus marks, then the bare marks.

    Derived by rule from the Unicode decompositions of all code points. Letters such as o-slash do
    not decompose and stay, and so do Korean syllables, whose parts are letters and no marks.
    """
    letters, plain, marks = [], [], []
    for point in range(0xC0, sys.maxunicode + 1):
        if 0xD800 <= point <= 0xDFFF or 0xAC00 <= point <= 0xD7A3:
            continue
        letter = chr(point)
        if unicodedata.category(letter).startswith("M"):
            marks.append(letter)
            continue
        bare = "".join(c for c in unicodedata.normalize("NFD", letter) if not unicodedata.category(c).startswith("M"))
        bare = unicodedata.normalize("NFC", bare)
        if len(bare) == 1 and bare != letter:
            letters.append(letter)
            plain.append(bare)
    # translate() deletes the characters of the first string that have no partner in the second
    return "".join(letters + marks), "".join(plain)


def without_accents(text: Column | str) -> Column:
    letters, plain = _accent_table()
    return F.translate(as_column(text), letters, plain)


def slug(text: Column | str) -> Column:
    """``Série A`` -> ``serie_a``."""
    return without_accents(F.replace(F.lower(as_column(text)), F.lit(" "), F.lit("_")))
