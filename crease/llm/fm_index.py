"""Substring dedup over words by a compressed FM-index per shard.

A shard's pieces are joined into one word sequence, each closed by its own
separator.  Its Burrows-Wheeler transform is kept as a wavelet tree of bit
vectors with rank counts every 64 bits.  Pieces are streamed through the index
from their ends by backward search, one word at a time and all pieces of a
shard together; a bit per row marks where the depth of the common prefix falls
below the threshold, so that each step also gives the interval of the window
that begins here.  Where that interval has several rows, the matching
statistic of the place reaches the threshold.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm._repeats import SpacedWords, removal
from crease.llm.suffixes import Suffixes


class BitVector:
    """Bits packed by 64 with the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)])

    def rank1(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        mask = (np.uint64(1) << bit) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask).astype(np.int64)


class WaveletTree:
    """Rank of any symbol in a sequence of integers below ``sigma`` (the levels
    of the tree laid out as one bit vector each, zeros before ones)."""

    def __init__(self, values: np.ndarray, sigma: int):
        self.levels: list[tuple[int, BitVector, int]] = []
        now = values
        for shift in range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1):
            bits = (now >> shift) & 1
            zeros = len(now) - int(bits.sum())
            self.levels.append((shift, BitVector(bits.astype(np.uint8)), zeros))
            now = np.concatenate([now[bits == 0], now[bits == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before position ``at``, elementwise."""
        start = np.zeros(len(at), np.int64)
        for shift, bits, zeros in self.levels:
            one = ((symbol >> shift) & 1).astype(bool)
            a, b = bits.rank1(start), bits.rank1(at)
            start = np.where(one, zeros + a, start - a)
            at = np.where(one, zeros + b, at - b)
        return at - start


class Intervals:
    """The rows of an index in intervals that share their first ``depth`` symbols."""

    def __init__(self, begins: np.ndarray):
        self._of_row = np.cumsum(begins, dtype=np.int32) - 1
        self.size = np.diff(np.append(np.flatnonzero(begins), len(begins)))

    def of(self, row: np.ndarray) -> np.ndarray:
        return self._of_row[row]


class FMIndex:
    """Backward steps over a sequence of integers from 0."""

    def __init__(self, values: np.ndarray, depth: int):
        suffixes = Suffixes(values, boundary=depth)
        sigma = int(values.max()) + 1
        self.before = np.concatenate([[0], np.cumsum(np.bincount(values, minlength=sigma))])
        self.tree = WaveletTree(values[suffixes.order - 1], sigma)  # the symbol before each
        self.intervals = Intervals(suffixes.begins)

    def step(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """The row of ``symbol + suffix`` from the row of ``suffix``."""
        return self.before[symbol] + self.tree.rank(symbol, row)


def matching_intervals(index, text: np.ndarray, begins: np.ndarray, ends: np.ndarray
                       ) -> np.ndarray:
    """For each place of the pieces ``begins[i]:ends[i]`` of ``text``, the interval of
    the window that begins there.  Separator ``i`` closes piece ``i`` and is the
    smallest symbol but for ``i`` others, so its suffix is row ``i``."""
    found = np.full(len(text), -1, np.int32)
    by_size = np.argsort(begins - ends)  # longest first
    end, size = ends[by_size], (ends - begins)[by_size]
    row = by_size.astype(np.int64)
    for back in range(1, int(size[0]) + 1 if len(size) else 0):
        live = int(np.searchsorted(-size, -back, side="right"))
        at = end[:live] - back
        row = index.step(text[at], row[:live])
        found[at] = index.intervals.of(row)
    return found


def repeats_in(index_of, text: np.ndarray, ends: np.ndarray, window: int):
    """``(piece, start, count)``: runs of windows that are also in the shard earlier.
    ``ends[i]`` is where piece ``i`` ends; its separator follows."""
    index = index_of(text, window)
    begins = np.concatenate([[0], ends[:-1] + 1])
    interval = matching_intervals(index, text, begins, ends)
    count = np.maximum(ends - begins - window + 1, 0)
    piece = np.repeat(np.arange(len(ends)), count)
    offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    interval = interval[begins[piece] + offset]
    several = np.flatnonzero(index.intervals.size[interval] > 1)
    # windows are in order, earliest first: the first of each interval stays
    first = np.unique(interval[several], return_index=True)[1]
    later = np.delete(several, first)
    piece, offset = piece[later], offset[later]
    new = np.ones(len(later), bool)
    new[1:] = (piece[1:] != piece[:-1]) | (offset[1:] != offset[:-1] + 1)
    run = np.flatnonzero(new)
    return piece[run], offset[run], np.diff(np.append(run, len(later)))


def _find(window: int):
    def find(pieces: list[bytes]):
        words = [p.split(b" ") for p in pieces]
        codes: dict[bytes, int] = {}
        # separators take the codes from 0, so that no window runs across one
        flat = np.array([codes.setdefault(w, len(codes)) for ws in words for w in ws], np.int64)
        sizes = np.array([len(ws) for ws in words])
        ends = np.cumsum(sizes + 1) - 1
        text = np.empty(len(flat) + len(words), np.int64)
        is_word = np.ones(len(text), bool)
        is_word[ends] = False
        text[is_word] = flat + len(words)
        text[ends] = np.arange(len(words))
        return repeats_in(FMIndex, text, ends, window)

    return find


def _kept(text: bytes, ranges: list[tuple[int, int]]) -> tuple[bytes, int]:
    words = text.split()
    n = len(words)
    for a, b in reversed(ranges):
        del words[a:b]
    return b" ".join(words), n


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                    window: int = 20, **options) -> DataFrame:
    """``(doc_id, n_words, spans, kept_text)``, one row per input row.

    ``spans`` are the maximal word ranges ``[start, end)`` covered by windows
    of ``window`` words that also start earlier (smaller id, or same document,
    earlier start); ``kept_text`` has the other words, joined by one space.
    NULL texts are empty and texts shorter than a window have no spans.  NULL
    ids come first; rows that share an id are ordered by a 64-bit hash of
    their text, and rows that are the same in both are one document with one result.
    Other columns are not read; an empty table gives an empty result.
    """
    out = removal(docs, id_col, text_col, SpacedWords(window), _find(window), _kept, **options)
    return out.select("doc_id", F.col("n").alias("n_words"), "spans",
                      F.col("kept").cast("string").alias("kept_text"))
