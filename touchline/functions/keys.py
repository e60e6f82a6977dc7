"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline.functions._columns import as_column


def surrogate_key(prefix: str, *parts: Column | str, separator: str = "") -> Column:
    """``prefix_<md5 of the parts as text>``; NULL as soon as one part is NULL.

    Parts are joined without a separator by default, so ("1", "23") and ("12", "3")
    share a key; pass ``separator="|"`` to tell them apart.
    """
    texts = [as_column(part).cast("string") for part in parts]
    if separator:
        texts = [text for pair in ((F.lit(separator), t) for t in texts) for text in pair][1:]
    joined = texts[0] if len(texts) == 1 else F.concat(*texts)
    return F.concat(F.lit(f"{prefix}_"), F.md5(joined))
