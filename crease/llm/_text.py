"""Vectorised words and hashes over the UTF-8 bytes of an Arrow string column.

All arrays address one contiguous byte buffer, so a batch of documents is
tokenised and hashed with a few numpy passes instead of a Python loop.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: bytes handled by one numpy pass; bounds the working memory
PASS_BYTES = 1 << 20

_U = np.uint64


def mix(x: np.ndarray, own: bool = False) -> np.ndarray:
    """A bijective scrambling of 64-bit values, in place if ``own``."""
    with np.errstate(over="ignore"):
        x = x if own else x.copy()
        for _ in range(2):
            x ^= x >> _U(32)
            x *= _U(0xD6E8FEB86659FD93)
        x ^= x >> _U(32)
        return x


_BYTE_VALUE = mix(np.arange(1, 257, dtype=_U))

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~SPACE

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

#: modulus of the rolling hash, a prime: a polynomial that is not zero has few roots,
#: so no pattern of symbols collides whatever the base, as it does modulo 2^64
_P = (1 << 31) - 1
#: ``(bits of a value that a lane takes, its base)``; the bases were drawn once.
#: Two ranges of n values share both lanes with a chance of (n / 2^31)^2 at most.
_LANES = ((0, 1_171_286_443), (31, 768_542_519))

_powers: dict[int, np.ndarray] = {}


def _pow(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo the prime, for ``i`` below ``n`` at least."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, PASS_BYTES + 4096)
        have = np.ones(1, _U)
        while len(have) < size:  # the next half is the first half times a power
            have = np.concatenate([have, have * _U(pow(base, len(have), _P)) % _U(_P)])
        have = have[:size].astype(np.uint32)  # below 2^31; half the memory that a worker keeps
        if n <= 2 * PASS_BYTES:
            _powers[base] = have
    return have


def _fold(x: np.ndarray) -> np.ndarray:
    """Equal modulo the prime and smaller: below 2^33 for any 64-bit value, then below
    2^31 + 4."""
    high = x >> _U(31)
    x = x & _U(_P)
    x += high
    return x


class Rolling:
    """Hashes of any range of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self._lanes = []
        for shift, base in _LANES:
            term = (values >> _U(shift)) & _U(_P)
            term *= _pow(base, n)[:n]
            sums = np.zeros(n + 1, dtype=_U)
            np.cumsum(_fold(term), out=sums[1:])  # terms below 2^33: no overflow
            self._lanes.append((sums, _pow(pow(base, -1, _P), n + 1)))

    @staticmethod
    def _lane(raw: np.ndarray, inverse: np.ndarray) -> np.ndarray:
        out = _fold(_fold(raw))
        out *= inverse
        out = _fold(_fold(_fold(out)))
        out[out >= _U(_P)] -= _U(_P)
        return out

    @staticmethod
    def _mixed(lanes: list[np.ndarray], length: np.ndarray | np.uint64) -> np.ndarray:
        with np.errstate(over="ignore"):
            out = lanes[0] << _U(31)
            out |= lanes[1]
            out ^= length * _U(0xA0761D6478BD642F)
        return mix(out, own=True)

    def every(self, length: int) -> np.ndarray:
        """The hash of each range of ``length`` values, as ``of`` gives it."""
        lanes = []
        for sums, inverse in self._lanes:
            raw = sums[length:] - sums[:-length]
            lanes.append(self._lane(raw, inverse[:len(raw)]))
        with np.errstate(over="ignore"):
            return self._mixed(lanes, _U(length))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self._mixed([self._lane(sums[end] - sums[start], inverse[start])
                            for sums, inverse in self._lanes], (end - start).astype(_U))


def byte_hashes(data: np.ndarray) -> Rolling:
    return Rolling(_BYTE_VALUE[data])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its ``n + 1`` offsets; NULL is empty."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if large else np.int32)
    off = off[column.offset:column.offset + len(column) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def groups(offsets: np.ndarray, limit: int = PASS_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``limit`` bytes together, one document at least."""
    n, at = len(offsets) - 1, 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(n, max(at + 1, to))
        yield at, to
        at = to


class Words:
    """Words of the documents in ``data``: byte ranges, 64-bit hashes and, per
    document, the range ``first[i]:first[i + 1]`` of its words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = NOT_SPACE,
                 hashed: bool = True):
        inside = is_word[data]
        n = len(data)
        begins = np.zeros(n + 1, bool)
        begins[offsets[:-1]] = True
        begins = begins[:n]
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        self.start = np.flatnonzero(inside & (~before | begins))
        after = np.zeros(n, bool)
        after[:-1] = inside[1:] & ~begins[1:]
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)
        if hashed:
            self.hash = np.empty(len(self.start), _U)
            # a pass may begin at any word; hashes do not depend on where it does
            at = 0
            while at < len(self.start):
                to = int(np.searchsorted(self.end, self.start[at] + PASS_BYTES, side="right"))
                to = max(at + 1, to)
                a, b = self.start[at], self.end[to - 1]
                self.hash[at:to] = byte_hashes(data[a:b]).of(self.start[at:to] - a,
                                                             self.end[at:to] - a)
                at = to

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def shingle_hashes(words: Words, size: int) -> list[np.ndarray]:
    """Per document the sorted distinct hashes of its ``size``-word shingles; a
    document of fewer words has its whole sequence as one, none without words."""
    rolling = Rolling(words.hash)
    n = len(words.hash)
    every = rolling.every(size) if n >= size else np.zeros(0, _U)
    out = []
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        if b - a >= size:
            out.append(np.unique(every[a:b - size + 1]))
        elif b > a:
            out.append(rolling.of(np.array([a]), np.array([b])))
        else:
            out.append(np.zeros(0, _U))
    return out


def strings(data: np.ndarray, offsets: np.ndarray) -> Iterator[bytes]:
    raw = data.tobytes()
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield raw[a:b]
