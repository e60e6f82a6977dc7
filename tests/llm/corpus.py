"""Small made-up texts."""

import random as _random


def prose(seed, n):
    """``n`` words that hardly any other seed shares in a row."""
    random = _random.Random(str(seed))
    return " ".join("".join(random.choice("abcdefghijklmnop") for _ in range(random.randrange(2, 9))) for _ in range(n))


AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "word"),
    (None, "a row without a number, and a word or two more than ten of them"),
    (5, "é" * 30_000 + " x" * 30_000),
    (6, prose(6, 300)),
    (6, prose(6, 300)),
    (7, prose(6, 300)),
]
"""NULLs, empty and very long texts, repeated rows and ties."""
