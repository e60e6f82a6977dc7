"""Token ids of whole texts with a public tokenizer, encoding each distinct piece of text once.

The tokenizers in use never make a token across certain places: before a white space that follows a
visible character, after a lone line break, and between a letter and a full stop or comma. A
text cut there gives the same ids as the whole text. The cuts are found in the UTF-8 bytes of a whole batch,
equal pieces are found by Arrow, and the tokenizers library only sees pieces not seen before.

The strings of special tokens, such as ``<|endoftext|>``, become those tokens' ids where a text holds
them, as in the library's plain call with ``add_special_tokens=False``; that is ``special=True``.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from tokenizers import Tokenizer

KNOWN = 1_000_000
"""Pieces a worker remembers; beyond it starts afresh."""


def slices(batches: Iterator[pa.RecordBatch], size: int = 8 * 1024 * 1024) -> Iterator[pa.RecordBatch]:
    """The batches cut where their texts, in the second column, pass ``size`` bytes: it bounds what a worker holds."""
    for batch in batches:
        total = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        low = 0
        while low < len(batch):
            before = total[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(total, before + size, side="right")))
            yield batch.slice(low, high - low)
            low = high


def path_of(name: str) -> str:
    return public_tokenizers.path(name)


def cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where pieces begin in the bytes of texts that themselves begin at ``starts``; sorted."""
    if not len(data):
        return np.zeros(0, dtype=np.int64)
    before = np.zeros((3, len(data)), dtype=np.uint8)  # the three bytes in front of each
    for back in range(3):
        before[back, back + 1 :] = data[: len(data) - back - 1]
    last, second, third = before
    visible = (last > 32) & (last < 127)
    # other scripts' letters and signs are visible too; wide spaces are not, and whatever might be one is not cut at
    wide = ((second == 0xC2) & ((last == 0x85) | (last == 0xA0))) | ((third >= 0xE1) & (third <= 0xE3) & ((second == 0x9A) | (second == 0x80) | (second == 0x81)))
    visible |= (last >= 0x80) & ~wide
    blank = (data == 32) | (data == 10)
    cut = blank & visible
    # a line break alone between visible characters is a token of its own
    lone = np.zeros(len(data), dtype=bool)
    lone[1:] = cut[:-1] & (data[:-1] == 10)
    cut |= lone & (data > 32) & (data < 127)
    lower = last | 0x20
    letter = (lower >= 97) & (lower <= 122) | ((second == 0xC3) & (last >= 0x80) & (last != 0x97) & (last != 0xB7))
    cut |= ((data == 46) | (data == 44)) & letter
    # what was looked at must belong to the same text: near a beginning nothing is cut
    for at in range(3):
        near = starts + at
        cut[near[near < len(data)]] = False
    cut[starts[starts < len(data)]] = True
    return np.flatnonzero(cut)


class Encoder:
    """Encodes Arrow string arrays; one per worker process, file and reading of special tokens.

    With ``special`` their strings in a text are those tokens, without it ordinary text.
    """

    _made: dict[tuple[str, bool], Encoder] = {}

    @classmethod
    def of(cls, path: str, special: bool = False) -> Encoder:
        if (path, special) not in cls._made:
            cls._made[path, special] = cls(path, special)
        return cls._made[path, special]

    def __init__(self, path: str, special: bool = False):
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = not special
        strings = [token.content.encode() for token in self._tokenizer.get_added_tokens_decoder().values()] if special else []
        self._special = re.compile(b"|".join(map(re.escape, sorted(strings, key=len, reverse=True)))) if strings else None
        self._known: dict[str, bytes] = {}

    def _learn(self, pieces: list[str]) -> None:
        if len(self._known) > KNOWN:
            self._known.clear()
        new = [piece for piece in pieces if piece not in self._known]
        for low in range(0, len(new), 10_000):
            part = new[low : low + 10_000]
            for piece, done in zip(part, self._tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self._known[piece] = array("I", done.ids).tobytes()

    def _whole(self, data: np.ndarray, starts: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """The cuts without those in or next to a special token's string; texts still begin at ``starts``."""
        found = [match.span() for match in self._special.finditer(np.ascontiguousarray(data))] if self._special and len(data) else []
        if not found:
            return begins
        firsts, lasts = np.array(found).T
        at = np.searchsorted(firsts, begins, side="right") - 1  # the last string that begins there or before
        near = (at >= 0) & (begins <= lasts[at] + 1)
        return np.union1d(begins[~near], starts)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids as ``uint32``, and where each text's begin: one more place than there are texts."""
        texts = texts.cast(pa.large_string()).fill_null("")
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        _, offsets, buffer = texts.buffers()
        places = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(buffer, dtype=np.uint8)[places[0] : places[-1]] if buffer is not None and len(texts) else np.zeros(0, np.uint8)
        places = places - places[0] if len(texts) else np.zeros(1, np.int64)
        filled = places[:-1][places[1:] > places[:-1]]
        begins = self._whole(data, filled, cuts(data, filled))
        if not len(begins):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        bounds = np.append(begins, len(data))
        pieces = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))).dictionary_encode()
        distinct = pieces.dictionary.to_pylist()
        self._learn(distinct)
        coded = [self._known[piece] for piece in distinct]
        flat = np.frombuffer(b"".join(coded), dtype=np.uint32)
        sizes = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded)) // 4
        firsts = np.cumsum(sizes) - sizes
        index = pieces.indices.to_numpy(zero_copy_only=False)
        each = sizes[index]
        ends = np.cumsum(each)
        ids = flat[np.repeat(firsts[index] - (ends - each), each) + np.arange(ends[-1])]
        # ids before the first piece of each text
        place = np.searchsorted(begins, places)
        return ids, np.append(0, ends)[place]
