"""Substring dedup over bytes by a run-length compressed index per shard.

The Burrows-Wheeler transform of a shard is kept as its runs only: the symbol
and first row of each run, and per symbol the list of its runs with the number
of that symbol before each.  In a repetitive shard there are far fewer runs
than bytes.  Ranks are found by binary search among the runs of the symbol.
Positions are not sampled at the run ends: the earliest place of a window comes
from the order of the windows in the shard, and the interval of a row is held
for each row (``Intervals``), so that part takes the space of the rows, not of
the runs.  Pieces are streamed from
their ends, one byte at a time and all pieces of a shard together, as in the
index over words (``fm_index``).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm._repeats import Bytes, removal
from crease.llm.fm_index import Intervals, repeats_in
from crease.llm.suffixes import Suffixes


class RunIndex:
    """Backward steps in the space of the runs of the transform; the intervals
    take the space of its rows."""

    def __init__(self, values: np.ndarray, depth: int):
        suffixes = Suffixes(values, boundary=depth)
        self.intervals = Intervals(suffixes.begins)
        self.n = n = len(values)
        bwt = values[suffixes.order - 1]
        head = np.flatnonzero(np.concatenate([[True], bwt[1:] != bwt[:-1]]))
        size = np.diff(np.append(head, n))
        symbol = bwt[head]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(values))])
        # runs by symbol, then by row: one sorted key serves all binary searches
        by = np.lexsort((head, symbol))
        self.symbol, self.head, self.size = symbol[by], head[by], size[by]
        self.key = self.symbol * (n + 1) + self.head
        self.first_run = np.searchsorted(self.symbol, np.arange(len(self.before)))
        total = np.concatenate([[0], np.cumsum(self.size)])
        self.seen = total[:-1] - total[self.first_run[self.symbol]]

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs in the transform before row ``at``."""
        run = np.searchsorted(self.key, symbol * (self.n + 1) + at) - 1
        here = run >= self.first_run[symbol]
        run = np.maximum(run, 0)
        inside = np.minimum(at - self.head[run], self.size[run])
        return np.where(here, self.seen[run] + inside, 0)

    def step(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """The row of ``symbol + suffix`` from the row of ``suffix``."""
        return self.before[symbol] + self.rank(symbol, row)


def _find(window: int):
    def find(pieces: list[bytes]):
        sizes = np.array([len(p) for p in pieces])
        ends = np.cumsum(sizes + 1) - 1
        text = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8).astype(np.int64) + len(pieces)
        text[ends] = np.arange(len(pieces))  # a separator for each piece
        return repeats_in(RunIndex, text, ends, window)

    return find


def _kept(text: bytes, ranges: list[tuple[int, int]]) -> tuple[bytes, int]:
    out, at = [], 0
    for a, b in ranges:
        out.append(text[at:a])
        at = b
    out.append(text[at:])
    return b"".join(out), len(text)


def byte_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
               window: int = 100, **options) -> DataFrame:
    """``(doc_id, n_bytes, spans, kept)``, one row per input row.

    Texts are UTF-8 bytes.  ``spans`` are the maximal byte ranges ``[start,
    end)`` covered by strings of ``window`` bytes that also start earlier
    (smaller id, or same document, earlier start), overlaps included; ``kept``
    has the other bytes (binary: a cut may split a character).  NULL texts are
    empty, shorter texts have no spans.  NULL ids come first; rows that share
    an id are ordered by a 64-bit hash of their text, and rows that are the same
    in both are one document with one result.  Other columns are not read; an
    empty table gives an empty result.
    """
    out = removal(docs, id_col, text_col, Bytes(window), _find(window), _kept, **options)
    return out.select("doc_id", F.col("n").alias("n_bytes"), "spans", "kept")
