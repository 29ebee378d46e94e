"""Benchmark decontamination by suffix arrays over the training documents.

Each task lays its documents out in shards of bounded size and builds the
suffix array of a shard's words.  Every suffix of every benchmark item is then
binary-searched in the shard, to the depth of a whole window; the interval
found lists all places where the window occurs.  Hits of one item on one
diagonal join into the longest verbatim matches.

The benchmark is the stated query set.  It is sent to the tasks in blocks of
at most ``block_bytes``, each block in its own pass over the documents, so
what a task holds does not grow with the benchmark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crease.llm import _text
from crease.llm._common import map_batches, map_rows, saved, whole_text
from crease.llm.suffixes import suffix_array

WINDOW = 13

#: word bytes: digits, letters after lower-casing, all bytes of other characters
_WORD = np.zeros(256, bool)
_WORD[ord("0"):ord("9") + 1] = True
_WORD[ord("a"):ord("z") + 1] = True
_WORD[128:] = True
_TABLE = bytes(int(_text.LOWER[b]) if _WORD[_text.LOWER[b]] else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class Benchmark:
    """The windows of a block of items, as rows of word codes."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.window = window
        self.codes: dict[bytes, int] = {}
        self.ids = [i for i, _ in items]
        rows, owner, offset = [], [], []
        for at, (_, text) in enumerate(items):
            words = [self.codes.setdefault(w, len(self.codes) + 1) for w in words_of(text)]
            if not words:
                continue
            for start in range(max(1, len(words) - window + 1)):
                rows.append(words[start:start + window])
                owner.append(at)
                offset.append(start)
        self.length = np.array([len(r) for r in rows], np.int64)
        self.patterns = np.zeros((len(rows), window), np.int64)
        for i, row in enumerate(rows):
            self.patterns[i, :len(row)] = row
        self.owner = np.array(owner, np.int64)
        self.offset = np.array(offset, np.int64)


def _bound(text: np.ndarray, order: np.ndarray, patterns: np.ndarray, length: np.ndarray,
           above: bool) -> np.ndarray:
    """Binary search of every pattern: the first suffix not below it, or above it."""
    low = np.zeros(len(patterns), np.int64)
    high = np.full(len(patterns), len(order), np.int64)
    while (open_ := np.flatnonzero(low < high)).size:
        mid = (low[open_] + high[open_]) // 2
        at = order[mid]
        right = np.full(len(open_), above)  # a suffix that begins with the pattern
        undecided = np.ones(len(open_), bool)
        for j in range(patterns.shape[1]):
            undecided &= j < length[open_]
            if not undecided.any():
                break
            have, want = text[at + j], patterns[open_, j]
            right[undecided & (have < want)] = True
            right[undecided & (have > want)] = False
            undecided &= have == want
        low[open_[right]] = mid[right] + 1
        high[open_[~right]] = mid[~right]
    return low


def shard_hits(text: np.ndarray, bench: Benchmark) -> tuple[np.ndarray, np.ndarray]:
    """``(position, pattern)`` of every occurrence of every window in ``text``, a
    sequence of word codes where 0 is any word (or boundary) not in the block."""
    padded = np.concatenate([text, np.zeros(bench.window, np.int64)])
    order = suffix_array(text, depth=bench.window)
    order = order[np.searchsorted(text[order], 1):]  # known first word
    low = _bound(padded, order, bench.patterns, bench.length, above=False)
    high = _bound(padded, order, bench.patterns, bench.length, above=True)
    count = high - low
    pattern = np.repeat(np.arange(len(low)), count)
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return order[low[pattern] + inside], pattern


def _matches(starts: np.ndarray, patterns: np.ndarray, bench: Benchmark):
    """Runs of hits of one item on one diagonal: item, document and item offset, length."""
    owner, offset = bench.owner[patterns], bench.offset[patterns]
    by = np.lexsort((starts, starts - offset, owner))
    owner, offset, starts = owner[by], offset[by], starts[by]
    length = bench.length[patterns][by]
    new = np.ones(len(by), bool)
    new[1:] = ((owner[1:] != owner[:-1]) | (starts[1:] != starts[:-1] + 1)
               | (offset[1:] != offset[:-1] + 1))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(by)) - 1
    return owner[first], starts[first], offset[first], starts[last] - starts[first] + length[last]


_MATCH = pa.struct([("item", pa.string()), ("doc_start", pa.int64()), ("item_start", pa.int64()),
                    ("length", pa.int64())])
_FOUND = (T.StructType().add("n_words", T.LongType())
          .add("matches", T.ArrayType(T.StructType().add("item", T.StringType())
                                      .add("doc_start", T.LongType())
                                      .add("item_start", T.LongType())
                                      .add("length", T.LongType()))))


def _search(batch: pa.RecordBatch, bench: Benchmark, shard_words: int):
    """Word counts and longest matches of the texts of a batch."""
    texts = batch.column("text").cast(pa.binary()).to_pylist()
    counts = np.zeros(len(texts), np.int64)
    matches: list[list[dict]] = [[] for _ in texts]
    code = bench.codes.get
    held: list[np.ndarray] = []
    docs: list[int] = []

    def shard() -> None:
        ends = np.cumsum([len(h) + 1 for h in held])
        text = np.zeros(ends[-1], np.int64)
        for end, h in zip(ends, held, strict=True):
            text[end - 1 - len(h):end - 1] = h
        position, pattern = shard_hits(text, bench)
        if not len(position):
            return
        of = np.searchsorted(ends, position, side="right")
        for d in np.unique(of):
            mine = of == d
            begin = ends[d] - 1 - len(held[d])
            found = _matches(position[mine] - begin, pattern[mine], bench)
            matches[docs[d]] += [
                {"item": bench.ids[i], "doc_start": a, "item_start": b, "length": n}
                for i, a, b, n in zip(*(x.tolist() for x in found), strict=True)]

    size = 0
    for at, text in enumerate(texts):
        words = words_of(text)
        counts[at] = len(words)
        codes = np.fromiter((code(w, 0) for w in words), np.int64, len(words))
        if len(words) and codes.any():
            held.append(codes)
            docs.append(at)
            size += len(words)
        if size >= shard_words:
            shard()
            held, docs, size = [], [], 0
    if held:
        shard()
    return counts, matches


def _blocks(items: DataFrame, item_col: str, text_col: str, block_bytes: int
            ) -> Iterator[list[tuple[str, bytes]]]:
    """The items in blocks of about ``block_bytes``, one on the driver at a time."""
    rows = items.select(F.col(item_col).cast("string").alias("item"),
                        whole_text(text_col).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = total // block_bytes + 1
    for at in range(n):
        block = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == at).distinct()
        yield [(r.item, r.text.encode()) for r in block.collect()]


def benchmark_matches(docs: DataFrame, items: DataFrame, *, text_col: str = "text",
                      item_col: str = "item_id", item_text_col: str = "text",
                      window: int = WINDOW, block_bytes: int = 16 << 20,
                      shard_words: int = 1 << 19) -> DataFrame:
    """``(row, n_words, matches)``: each input row (as a struct of all its columns),
    its number of words and its longest verbatim matches with items.

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased.
    A match is at least ``window`` words long, or the whole of an item that has
    fewer words.  NULL or empty texts have no words and no matches; items
    without words match nothing; items that repeat an id add up, and items with
    a NULL id are searched as all others (``item`` is then NULL).
    Rows are handled one by one, so repeated rows and ids get equal results.
    Empty tables (documents or benchmark) give no matches.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    body = T.StructType([*rows.schema.fields, *_FOUND.fields])
    out = None
    for block in _blocks(items, item_col, item_text_col, block_bytes):
        bench = docs.sparkSession.sparkContext.broadcast(Benchmark(block, window))
        if out is None:
            now = rows.withColumns({"n_words": F.lit(0).cast("bigint"),
                                    "matches": F.array().cast(_FOUND["matches"].dataType)})
        else:
            now = saved(out, "block")
        now = now.withColumn("text", whole_text(F.col(f"row.`{text_col}`")))

        def search(batches, bench=bench):
            for batch in batches:
                counts, found = _search(batch, bench.value, shard_words)
                had = batch.column("matches").to_pylist()
                yield pa.record_batch({
                    "row": batch.column("row"), "n_words": counts,
                    "matches": pa.array([a + b for a, b in zip(had, found, strict=True)],
                                        pa.list_(_MATCH))})

        out = map_batches(now, search, body)
    return out


def verdict(found: DataFrame, percent: int = 5) -> DataFrame:
    """Adds ``n_hit``, ``items`` (sorted distinct item ids as strings, no NULL) and
    ``contaminated`` (``100 * n_hit >= percent * n_words``, at least one hit)."""

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        hits, items = [], []
        for matches in batch.column("matches").to_pylist():
            end = hit = 0
            for a, b in sorted((m["doc_start"], m["doc_start"] + m["length"]) for m in matches):
                hit += max(0, b - max(a, end))
                end = max(end, b)
            hits.append(hit)
            items.append(sorted({m["item"] for m in matches} - {None}))
        names = [*batch.schema.names, "n_hit", "items"]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(hits, pa.int64()), pa.array(items, pa.list_(pa.string()))],
            names=names)

    body = (T.StructType(list(found.schema.fields)).add("n_hit", T.LongType())
            .add("items", T.ArrayType(T.StringType())))
    out = map_rows(found, judge, body)
    return out.withColumn("contaminated", F.expr(f"n_hit > 0 AND 100 * n_hit >= {percent} * n_words"))


def clean_documents(docs: DataFrame, items: DataFrame, percent: int = 5, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with the same columns."""
    out = verdict(benchmark_matches(docs, items, **options), percent)
    return out.where("NOT contaminated").select("row.*")


def sha(column: Column) -> Column:
    """The digest of the query: ids joined by commas, SHA-256 in hex."""
    return F.sha2(F.array_join(column, ",").cast("binary"), 256)
