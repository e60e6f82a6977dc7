"""Adaptive context-mixing range coder for token ids, many independent blocks in step.

Every block starts from the same state and carries its own length and checksum, so it can be read alone and a
damaged one harms no other. Within a block, each id is coded as decisions:

* is it what the order-2 context (two ids before) predicts,
* if not, is it what the order-1 context predicts,
* if not, its two bytes, under adaptive order-0 frequencies.

The probability of the first decision mixes what each order's prediction has been worth so far, in the logistic
domain, with weights learned on the way. All arithmetic is on integers, so decoding retraces
encoding exactly on any machine. Numpy does one step of all blocks of a segment at a time.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK_IDS = 4096
LANES = 2048
"""Blocks coded in step. A step costs about as much for a few lanes as for all, so a segment should take one pass:
a task's share of a table is a few million ids, and a second, nearly empty pass doubled its time."""

_MAGIC = b"TRC1"
_HEAD = struct.Struct("<4sBIII")  # magic, 0 stored or 1 coded, ids, checksum, bytes
_SLOTS = 4096
_LOW_CONTEXTS = 16
_ROOM = 3  # words an id may take before a block is stored plainly


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Stretch over 4096 probabilities and its inverse over -2047 to 2047, as integers."""
    x = np.arange(-2047, 2048)
    squash = np.clip(np.round(4096 / (1 + np.exp(-x / 256.0))), 1, 4095).astype(np.int64)
    stretch = np.searchsorted(squash, np.arange(4096), side="left") - 2047
    return np.clip(stretch, -2047, 2047).astype(np.int64), squash


_STRETCH, _SQUASH = _tables()
_clip = np._core.umath.clip
"""``np.clip`` as the bare ufunc: the same values without its wrapper's cost, paid thousands of times a block."""


class _Coder:
    """Range coder with 48 bits of state and 16-bit words, one state per lane.

    An interval that straddles a word's border until it is too narrow is cut at the border, so nothing is ever carried.
    """

    def __init__(self, lanes: int, words: np.ndarray, decoding: bool):
        self.low, self.wide = np.zeros(lanes, dtype=np.uint64), np.full(lanes, _FULL, dtype=np.uint64)
        self.at, self.decoding = np.zeros(lanes, dtype=np.int64), decoding
        self.stride, self.words = words.shape[1], words.reshape(-1)
        self.base = np.arange(lanes, dtype=np.int64) * self.stride
        self.value = np.zeros(lanes, dtype=np.uint64)
        if decoding:
            for _ in range(3):
                self.value = (self.value << _16) | self.words[self.base + self.at]
                self.at += 1

    def target(self, who) -> np.ndarray:
        """Where in 0 to 65535 the coded symbol lies."""
        unit = self.wide[who] >> _16
        return np.minimum((self.value[who] - self.low[who]) // unit, _LAST).astype(np.int64)

    def narrow(self, who, start: np.ndarray, size: np.ndarray) -> None:
        """Goes on in the part ``start`` to ``start + size`` of 65536; ``who`` is a slice or lane numbers."""
        unit = self.wide[who] >> _16
        low, wide = self.low[who] + unit * start.astype(np.uint64), unit * size.astype(np.uint64)
        self.low[who], self.wide[who] = low, wide
        ready = ((low ^ (low + wide)) < _TOP) | (wide <= _LAST)
        if not ready.any():
            return
        lanes = np.flatnonzero(ready) if isinstance(who, slice) else who[ready]
        while len(lanes):
            low, wide = self.low[lanes], self.wide[lanes]
            narrow = (low ^ (low + wide)) >= _TOP
            if narrow.any():
                wide = np.where(narrow, (~low + np.uint64(1)) & _LAST, wide)
            at = self.at[lanes]
            place = self.base[lanes] + np.minimum(at, self.stride - 1)
            if self.decoding:
                self.value[lanes] = ((self.value[lanes] << _16) & _MASK) | self.words[place]
            else:
                self.words[place] = (low >> _32).astype(np.uint16)
            self.at[lanes] = at + 1
            low, wide = (low << _16) & _MASK, wide << _16
            self.low[lanes], self.wide[lanes] = low, wide
            lanes = lanes[((low ^ (low + wide)) < _TOP) | (wide <= _LAST)]

    def finish(self) -> None:
        for shift in (_32, _16, np.uint64(0)):
            place = self.base + np.minimum(self.at, self.stride - 1)
            self.words[place] = ((self.low >> shift) & _LAST).astype(np.uint16)
            self.at += 1


_16, _32, _LAST = np.uint64(16), np.uint64(32), np.uint64(65535)
_TOP, _MASK = np.uint64(1 << 32), np.uint64((1 << 48) - 1)
_FULL = np.uint64((1 << 48) - 1)


class _Frequencies:
    """Adaptive frequencies of 256 symbols in several contexts per lane; the sums are renewed now and then."""

    GAIN = 24

    def __init__(self, lanes: int, contexts: int):
        self.shape = (lanes, contexts, 256)
        self.counts = np.ones(lanes * contexts * 256, dtype=np.int32)
        self.sums = np.empty((lanes, contexts, 257), dtype=np.int32)
        self.renew()

    def renew(self) -> None:
        totals = np.cumsum(self.counts.reshape(self.shape), axis=2, dtype=np.int64)
        self.sums[:, :, 0] = 0
        self.sums[:, :, 1:] = totals * (65536 - 256) // totals[:, :, -1:] + np.arange(1, 257)
        self.flat = self.sums.reshape(-1)

    def code(self, coder: _Coder, who: np.ndarray, context: np.ndarray, symbol: np.ndarray | None) -> np.ndarray:
        row = who * self.shape[1] + context
        base = row * 257
        if symbol is None:
            target = coder.target(who)
            symbol = np.zeros(len(who), dtype=np.int64)
            for step in (128, 64, 32, 16, 8, 4, 2, 1):
                symbol += np.where(self.flat.take(base + symbol + step) <= target, step, 0)
        start = self.flat.take(base + symbol)
        coder.narrow(who, start, self.flat.take(base + symbol + 1) - start)
        self.counts[row * 256 + symbol] += self.GAIN
        return symbol


class _Guesses:
    """What followed a context last, and how often that came true in a row."""

    def __init__(self, lanes: int):
        self.id, self.trust = np.zeros(lanes * _SLOTS, dtype=np.int32), np.zeros(lanes * _SLOTS, dtype=np.int8)
        self.base = np.arange(lanes, dtype=np.int64) * _SLOTS

    def look(self, n: int, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        self.at = self.base[:n] + slot
        return self.id.take(self.at), self.trust.take(self.at).astype(np.int64)

    def learn(self, value: np.ndarray, guess: np.ndarray, trust: np.ndarray) -> None:
        right = guess == value
        self.id[self.at] = np.where(right | (trust > 1), guess, value)
        self.trust[self.at] = np.where(right, np.minimum(trust + 1, 15), np.where(trust > 1, trust >> 1, 1))


class _Mixer:
    """The chance that the first guess is right: what each of three views has been worth, mixed by learned weights."""

    def __init__(self, lanes: int):
        self.worth = [np.full(lanes * size, 2048, dtype=np.int64) for size in (32, 16, 32)]
        self.base = [np.arange(lanes, dtype=np.int64) * size for size in (32, 16, 32)]
        self.weight = [np.full(lanes, 24_000, dtype=np.int64) for _ in range(3)]

    def chance(self, n: int, contexts: tuple[np.ndarray, ...]) -> np.ndarray:
        self.at = [base[:n] + context for base, context in zip(self.base, contexts, strict=True)]
        self.seen = [worth.take(at) for worth, at in zip(self.worth, self.at, strict=True)]
        self.inputs = [_STRETCH.take(seen) for seen in self.seen]
        total = sum(weight[:n] * x for weight, x in zip(self.weight, self.inputs, strict=True)) >> 16
        self.p = _clip(_SQUASH.take(_clip(total, -2047, 2047) + 2047), 16, 4080)
        return self.p

    def learn(self, n: int, bit: np.ndarray) -> None:
        truth = bit * 4095
        error = truth - self.p
        for k in range(3):
            self.weight[k][:n] += (self.inputs[k] * error * 3) >> 9
            self.worth[k][self.at[k]] = _clip(self.seen[k] + ((truth - self.seen[k]) >> 4), 1, 4095)


def _binary(coder: _Coder, who, p: np.ndarray, truth: np.ndarray | None) -> np.ndarray:
    """Codes a decision whose chance of being true is ``p`` in 4096ths."""
    edge = p << 4
    if truth is None:
        truth = coder.target(who) < edge
    coder.narrow(who, np.where(truth, 0, edge), np.where(truth, edge, 65536 - edge))
    return truth


def _run(count: np.ndarray, ids: np.ndarray, coder: _Coder) -> None:
    """Codes or decodes ``ids`` (places by lanes, longest lane first) as many as ``count`` says."""
    lanes = len(count)
    orders, mixer = (_Guesses(lanes), _Guesses(lanes)), _Mixer(lanes)
    second_worth, second_base = np.full(lanes * 16, 1024, dtype=np.int64), np.arange(lanes, dtype=np.int64) * 16
    high, low = _Frequencies(lanes, 1), _Frequencies(lanes, _LOW_CONTEXTS)
    last, before = np.zeros(lanes, dtype=np.int64), np.zeros(lanes, dtype=np.int64)
    active = lanes - np.searchsorted(count[::-1], np.arange(len(ids)), side="right")
    for place in range(len(ids)):
        n = int(active[place])
        everyone = slice(0, n)
        actual = None if coder.decoding else ids[place, :n]
        one, two = last[:n], before[:n]
        guess1, trust1 = orders[0].look(n, (one * 40503 >> 4) & (_SLOTS - 1))
        guess2, trust2 = orders[1].look(n, ((one * 40503 + two * 48271) * 31 >> 6) & (_SLOTS - 1))
        agree = guess1 == guess2
        first = np.where(trust2 > 0, guess2, guess1)
        p = mixer.chance(n, (trust1 * 2 + agree, trust2, (np.minimum(trust1, 3) * 4 + np.minimum(trust2, 3)) * 2 + agree))
        hit = _binary(coder, everyone, p, None if actual is None else actual == first)
        mixer.learn(n, hit)
        value = first.astype(np.int64)
        rest = np.flatnonzero(~hit)
        ask = (guess1.take(rest) != first.take(rest)) & (trust1.take(rest) > 0)
        other = rest[ask]
        if len(other):
            at = second_base[other] + trust1.take(other)
            p = second_worth[at]
            right = _binary(coder, other, _clip(p, 16, 4080), None if actual is None else actual[other] == guess1[other])
            second_worth[at] = p + ((right * 4095 - p) >> 4)
            value[other[right]] = guess1[other[right]]
            left = ~ask
            left[np.flatnonzero(ask)[~right]] = True
            rest = rest[left]
        if len(rest):
            truth = None if actual is None else actual[rest]
            top = high.code(coder, rest, np.zeros(len(rest), dtype=np.int64), None if truth is None else truth >> 8)
            bottom = low.code(coder, rest, top & (_LOW_CONTEXTS - 1), None if truth is None else truth & 255)
            value[rest] = top * 256 + bottom
        if coder.decoding:
            ids[place, :n] = value
        orders[0].learn(value, guess1, trust1)
        orders[1].learn(value, guess2, trust2)
        before[:n], last[:n] = one.copy(), value
        if place in (31, 127) or place % 256 == 255:
            high.renew()
        if place in (127, 383) or place % 1024 == 1023:
            low.renew()


def encode(ids: np.ndarray, block_ids: int = BLOCK_IDS) -> list[bytes]:
    """The ids, each below 65536, as blocks."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    parts = [ids[low : low + block_ids] for low in range(0, len(ids), block_ids)]
    out: list[bytes] = []
    for low in range(0, len(parts), LANES):
        lane = parts[low : low + LANES]
        count = np.array([len(part) for part in lane])
        order = np.argsort(-count, kind="stable")
        table = np.zeros((int(count.max()), len(lane)), dtype=np.int64)
        for column, i in enumerate(order):
            table[: count[i], column] = lane[i]
        words = np.zeros((len(lane), int(count.max()) * _ROOM + 8), dtype=np.uint16)
        coder = _Coder(len(lane), words, decoding=False)
        _run(count[order], table, coder)
        coder.finish()
        bodies: list[bytes] = [b""] * len(lane)
        for column, i in enumerate(order):
            bodies[i] = words[column, : coder.at[column]].astype("<u2").tobytes() if coder.at[column] < words.shape[1] else b""
        for part, body in zip(lane, bodies, strict=True):
            plain = part.tobytes()
            fits = 0 < len(body) < len(plain)
            out.append(_HEAD.pack(_MAGIC, int(fits), len(part), zlib.crc32(plain), len(body) if fits else len(plain)) + (body if fits else plain))
    return out


def decode(blocks: list[bytes]) -> np.ndarray:
    """The ids of blocks; raises ``ValueError`` where a block is damaged."""
    done: list[np.ndarray | None] = [None] * len(blocks)
    checks, coded = [], []
    for i, block in enumerate(blocks):
        if len(block) < _HEAD.size:
            raise ValueError(f"block {i} is cut off")
        magic, kind, count, check, size = _HEAD.unpack_from(block)
        if magic != _MAGIC or len(block) != _HEAD.size + size:
            raise ValueError(f"block {i} is no block of this format")
        checks.append(check)
        if kind:
            coded.append((i, count))
        else:
            done[i] = np.frombuffer(block, dtype="<u4", offset=_HEAD.size)
    for low in range(0, len(coded), LANES):
        lane = sorted(coded[low : low + LANES], key=lambda found: -found[1])
        count = np.array([n for _, n in lane])
        longest = max(len(blocks[i]) - _HEAD.size for i, _ in lane) // 2
        words = np.zeros((len(lane), longest + 4), dtype=np.uint16)
        for row, (i, _) in zip(words, lane, strict=True):
            body = np.frombuffer(blocks[i], dtype="<u2", offset=_HEAD.size, count=(len(blocks[i]) - _HEAD.size) // 2)
            row[: len(body)] = body
        table = np.zeros((int(count.max()), len(lane)), dtype=np.int64)
        _run(count, table, _Coder(len(lane), words, decoding=True))
        for column, (i, n) in enumerate(lane):
            done[i] = np.ascontiguousarray(table[:n, column]).astype("<u4")
    for i, (part, check) in enumerate(zip(done, checks, strict=True)):
        if zlib.crc32(part.tobytes()) != check:
            raise ValueError(f"block {i} fails its checksum")
    return np.concatenate(done) if done else np.zeros(0, dtype="<u4")
