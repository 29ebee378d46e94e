"""Pre-tokens of many texts at once, for tokenizer files that split by character class.

For the common text the steps before merging only look at one character at a
time: lower-casing maps it, and the pattern cuts where the class (letter,
digit, white space, other) changes and around every digit.  That is done here
for all characters of a batch with numpy, each pre-token gets a 64-bit hash,
and each distinct pre-token is encoded once.  Texts that need more (an
apostrophe, a character outside the tables or not in composed form) are left
to the steps of the tokenizer file, one by one.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from itertools import chain

import numpy as np
import regex

from crease.llm import _text

_LETTER, _DIGIT, _SPACE, _OTHER, _ODD = 0, 1, 2, 3, 4
#: characters below this have a class and a lower case in the tables
TABLE = 0x2000

_is_letter, _is_digit = regex.compile(r"\p{L}"), regex.compile(r"\p{N}")


def _tables() -> tuple[np.ndarray, np.ndarray]:
    kind = np.full(TABLE + 1, _OTHER, np.uint8)
    lower = np.arange(TABLE + 1, dtype=np.uint32)
    for code in range(TABLE):
        char = chr(code)
        small = char.lower()
        category = unicodedata.category(char)
        # marks and Hangul parts join with the character before them
        joins = category.startswith("M") or 0x1100 <= code < 0x1200
        if joins or category == "Cn" or len(small) != 1 or ord(small) >= TABLE \
                or code == ord("'") or not unicodedata.is_normalized("NFC", char):
            kind[code] = _ODD
        elif _is_letter.match(small):
            kind[code] = _LETTER
        elif _is_digit.match(small):
            kind[code] = _DIGIT
        elif char in " \t\n\r":
            kind[code] = _SPACE
        elif char.isspace() or category.startswith("C"):
            kind[code] = _ODD
        if len(small) == 1:
            lower[code] = min(ord(small), TABLE)
    kind[TABLE] = _ODD
    return kind, lower


_KIND, _LOWER = _tables()
_VALUE = _text.mix(np.arange(1, TABLE + 2, dtype=np.uint64))
#: characters hashed by one numpy pass, few enough to stay in the processor's cache
PASS = 1 << 16


class Memory:
    """The encodings of distinct pre-tokens by hash, laid end to end, and their
    characters: a hash finds an entry, equal characters make it the right one.

    ``encode`` gives the ids of pre-tokens.  At ``size`` entries it starts
    anew, so that a task's memory stays bounded whatever the corpus.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], size: int = 400_000):
        self.encode = encode
        self.size = size
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted
        self.begin = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.at = np.zeros(0, np.int64)
        self.size_of = np.zeros(0, np.int64)
        self.chars = np.zeros(0, np.uint32)

    def rows(self, keys: np.ndarray, chars_of: Callable[[np.ndarray], tuple]) -> np.ndarray:
        """Rows of the distinct sorted ``keys``, encoding the ones not known.
        ``chars_of`` gives the sizes of pre-tokens and their characters end to end."""
        if len(self.keys) > self.size:
            self.clear()
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        new = np.flatnonzero(~known)
        if len(new):
            size, chars = chars_of(new)
            flat = chars.astype("<u4").tobytes().decode("utf-32-le")
            cut = np.concatenate([[0], np.cumsum(size)]).tolist()
            ids = self.encode([flat[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)])
            place = len(self.chars) + np.cumsum(size) - size
            self.chars = np.concatenate([self.chars, chars])
            count = np.array([len(x) for x in ids], np.int64)
            begin = len(self.ids) + np.cumsum(count) - count
            self.ids = np.concatenate([self.ids, np.fromiter(
                chain.from_iterable(ids), np.uint32, int(count.sum()))])
            # both are sorted: the new keys go before the known ones that they were looked up at
            to = at[new] + np.arange(len(new))
            known = np.ones(len(self.keys) + len(new), bool)
            known[to] = False
            for name, more in (("keys", keys[new]), ("begin", begin), ("count", count),
                               ("at", place), ("size_of", size)):
                merged = np.empty(len(known), more.dtype)
                merged[known], merged[to] = getattr(self, name), more
                setattr(self, name, merged)
            at = np.searchsorted(self.keys, keys)
        return at


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``start[i], start[i] + 1, ...`` for ``size[i]`` each, end to end."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


def encode_plain(texts: list[str], memory: Memory) -> list[np.ndarray | None]:
    """The ids of each text, or None where the tables do not reach."""
    if not texts:
        return []
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    if offsets[-1] == 0:
        return [np.zeros(0, np.uint32) for _ in texts]
    capped = np.minimum(codes, TABLE).astype(np.intp)
    kind = _KIND.take(capped)
    odd = np.concatenate([[0], np.cumsum(kind == _ODD, dtype=np.int64)])
    fine = odd[offsets[1:]] == odd[offsets[:-1]]
    chars = _LOWER.take(capped)
    begins = np.ones(len(kind), bool)
    begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    begins[offsets[:-1][offsets[:-1] < len(kind)]] = True
    start = np.flatnonzero(begins)
    end = np.append(start[1:], len(kind))
    word = kind[start] < _SPACE
    word |= kind[start] == _OTHER
    start, end = start[word], end[word]
    hashes = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(end, start[at] + PASS, side="right")))
        a, b = start[at], end[to - 1]
        hashes[at:to] = _text.Rolling(_VALUE.take(chars[a:b])).of(start[at:to] - a,
                                                                  end[at:to] - a)
        at = to
    keys, example, inverse = np.unique(hashes, return_index=True, return_inverse=True)

    def chars_of(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin, stop = start[example[new]], end[example[new]]
        return stop - begin, chars[spread(begin, stop - begin)]

    row = memory.rows(keys, chars_of)[inverse]
    # a text with a pre-token that only shares the hash of the one remembered is not done here
    size = end - start
    other = size != memory.size_of[row]
    if not other.any():
        inside = (kind < _SPACE) | (kind == _OTHER)  # the characters of the pre-tokens, in order
        unequal = chars[inside] != memory.chars.take(spread(memory.at[row], size))
        if unequal.any():
            other = np.add.reduceat(unequal, np.cumsum(size) - size) > 0
    if other.any():
        text = np.searchsorted(offsets, start[other], side="right") - 1
        fine[text] = False
    count = memory.count[row]
    ids = memory.ids.take(spread(memory.begin[row], count))
    # where the ids of each text begin
    total = np.concatenate([[0], np.cumsum(count)])
    cut = total[np.searchsorted(start, offsets)]
    return [ids[a:b] if ok else None for a, b, ok in zip(cut[:-1], cut[1:], fine, strict=True)]
