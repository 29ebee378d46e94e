"""Windows of a fixed length that also start earlier in the corpus.

The corpus is cut by content, not by document: a window belongs to its least
hashed k-gram (its minimizer), and neighbouring windows of one document that
share a minimizer travel as one *piece*.  Equal windows have their minimizer at
the same place, so bytes go further: windows with half of their other symbols
before the minimizer form one piece, keyed by it and that half, the others a
second, keyed by it and the half after it.  Equal windows always meet under the
same key, and a phrase that is followed by many different texts is no key of its
own.  The steps, each a stored table:

1. keys that occur once are settled (counts are combined before the shuffle);
2. equal pieces are settled by their digest: all but the earliest are repeats;
3. only keys with several *different* pieces go on, with the earliest piece of
   each kind.  Their contents fill index shards; every window of a shard is
   searched in the shard's index, and all members of its interval but the
   earliest are repeats;
4. a key with more than ``hot`` different pieces would overload a shard (a
   phrase in a third of all documents, each time before another text).  Its
   windows are dealt one by one by their own hash instead and settled as
   in step 2.

Rows are told apart and ordered by id, then by a 64-bit hash of the text, then by
start.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm import _text
from crease.llm._common import map_batches, map_rows, partitions, saved, whole_text

_U = np.uint64
#: symbols handled by one numpy pass
PASS = 1 << 18
_POSITION = _U((1 << 22) - 1)
_NONE = _U(0xFFFFFFFFFFFFFFFF)
_GRAM_BASE = 0x9E3779B97F4A7C15

PIECE = "h bigint, dig bigint, doc bigint, th bigint, at bigint"


class Sequence:
    """Windows and pieces of one run of symbols (documents laid end to end)."""

    def __init__(self, values: np.ndarray, bounds: np.ndarray, window: int, gram: int,
                 halves: bool = False):
        self.window, self.gram, self.halves = window, gram, halves
        self.values = values
        self.n = len(values)
        self.bounds = bounds
        self.roll = _text.Rolling(values)

    def window_ok(self) -> np.ndarray:
        """Whether a whole window starts at each symbol, inside one document."""
        last = np.maximum(self.bounds[1:] - self.window + 1, self.bounds[:-1])
        step = np.zeros(self.n + 1, np.int32)
        np.add.at(step, self.bounds[:-1], 1)
        np.add.at(step, last, -1)
        return np.cumsum(step[:-1], dtype=np.int32) > 0

    def _grams(self) -> np.ndarray:
        """A hash of each k-gram; that of halves only chooses minimizers, so modulo 2^64 will do."""
        if not self.halves:
            return self.roll.every(self.gram)
        out, width = self.values, 1
        with np.errstate(over="ignore"):
            while width < self.gram:
                step = min(width, self.gram - width)
                more = out[:-step] * _U(pow(_GRAM_BASE, step, 1 << 64))
                more += out[step:]
                out, width = more, width + step
        return _text.mix(out)

    def pieces(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First window, number of windows, key and digest of every piece."""
        none = np.zeros(0, np.int64)
        if self.n < self.window:
            return none, none, none, none
        grams = self._grams()
        low = grams & ~_POSITION
        low |= np.arange(len(grams), dtype=_U)
        span = self.window - self.gram + 1
        width = 1
        while 2 * width <= span:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < span:
            low = np.minimum(low[:len(low) - (span - width)], low[span - width:])
        at = (low & _POSITION).astype(np.int64)
        ok = self.window_ok()[:len(at)]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | ~ok[:-1]
        if self.halves:
            # windows that hold this half of their other symbols before the minimizer
            left = at - np.arange(len(at)) >= span // 2
            new[1:] |= left[1:] != left[:-1]
        first = np.flatnonzero(new & ok)
        if not len(first):
            return none, none, none, none
        # a run ends where the next one begins or the windows end
        ends = np.flatnonzero(ok & np.append(new[1:] | ~ok[1:], True)) + 1
        at = at[first]
        if self.halves:
            before = left[first]
            key = self.roll.of(np.where(before, at - span // 2, at),
                               at + np.where(before, self.gram, self.window - span // 2 + 1))
        else:
            key = grams[at]
        digest = _text.mix(self.roll.of(first, ends - 1 + self.window) + _U(0x5851F42D4C957F2D))
        return first, ends - first, key.view(np.int64), digest.view(np.int64)

    def window_digests(self, first: np.ndarray) -> np.ndarray:
        return _text.mix(self.roll.of(first, first + self.window)).view(np.int64)


class Symbols:
    """How a text becomes symbols; the two kinds differ in this alone."""

    window: int
    gram: int
    #: whether keys hold half of the symbols beside the minimizer
    halves = False

    def sequences(self, data: np.ndarray, offsets: np.ndarray
                  ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Values, bounds, and per bounded part its document and first symbol."""
        raise NotImplementedError

    def contents(self, text: bytes, spans: list[tuple[int, int]]) -> list[bytes]:
        """The bytes of symbol ranges of one text."""
        raise NotImplementedError


def _parts(counts: np.ndarray, window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Passes of ``(document, first symbol, end symbol)`` of about ``PASS`` symbols.
    A longer document is cut; its parts overlap so that each window is in one."""
    now: list[tuple[int, int, int]] = []
    held = 0
    for doc, n in enumerate(counts.tolist()):
        at = 0
        while n - at >= window or (at == 0 and n):
            to = min(n, at + PASS)
            now.append((doc, at, to))
            held += to - at
            if held >= PASS:
                yield now
                now, held = [], 0
            if to == n:
                break
            at = to - window + 1
    if now:
        yield now


class Bytes(Symbols):
    halves = True

    def __init__(self, window: int = 100, gram: int = 16):
        self.window, self.gram = window, gram

    def sequences(self, data, offsets):
        for parts in _parts(np.diff(offsets), self.window):
            doc, a, b = (np.array(x, np.int64) for x in zip(*parts, strict=True))
            values = np.concatenate([data[offsets[d] + x:offsets[d] + y] for d, x, y in parts])
            yield _text._BYTE_VALUE[values], np.concatenate([[0], np.cumsum(b - a)]), doc, a

    def contents(self, text, spans):
        return [text[a:b] for a, b in spans]


class SpacedWords(Symbols):
    def __init__(self, window: int = 20, gram: int = 4):
        self.window, self.gram = window, gram

    def sequences(self, data, offsets):
        for lo, hi in _text.groups(offsets):
            words = _text.Words(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
            for parts in _parts(words.counts(), self.window):
                doc, a, b = (np.array(x, np.int64) for x in zip(*parts, strict=True))
                values = np.concatenate([words.hash[words.first[d] + x:words.first[d] + y]
                                         for d, x, y in parts])
                yield values, np.concatenate([[0], np.cumsum(b - a)]), doc + lo, a

    def contents(self, text, spans):
        words = text.split()
        return [b" ".join(words[a:b]) for a, b in spans]


def _place(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Start and number of windows in one sortable integer."""
    return (start << 8) | n


def _located(batch: pa.RecordBatch, symbols: Symbols):
    """Pieces of a batch of texts: sequence, document row, start, count, key, digest."""
    data, offsets = _text.utf8(batch.column("text"))
    for values, bounds, doc, base in symbols.sequences(data, offsets):
        seq = Sequence(values, bounds, symbols.window, symbols.gram, symbols.halves)
        first, n, key, digest = seq.pieces()
        part = np.searchsorted(bounds, first, side="right") - 1
        yield seq, doc[part], first - bounds[part] + base[part], n, key, digest, first


def _pieces(source: DataFrame, symbols: Symbols) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc").to_numpy(zero_copy_only=False)
            th = batch.column("th").to_numpy(zero_copy_only=False)
            for _, doc, start, n, key, digest, _ in _located(batch, symbols):
                yield pa.record_batch({"h": key, "dig": digest, "doc": ids[doc], "th": th[doc],
                                       "at": _place(start, n)})

    return map_batches(source, cut, PIECE)


def _contents(source: DataFrame, wanted: DataFrame, symbols: Symbols) -> DataFrame:
    """The contents of the wanted pieces.  A piece of a hot key is cut into its
    windows: ``dig`` is then the window's digest and ``content`` is NULL."""
    per_doc = wanted.groupBy("doc", "th").agg(
        F.collect_list(F.struct("h", "at", "hot")).alias("pieces"))
    rows = source.join(saved(per_doc, "per_doc"), ["doc", "th"])
    window = symbols.window

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            docs = batch.column("doc").to_numpy(zero_copy_only=False)
            ths = batch.column("th").to_numpy(zero_copy_only=False)
            lists = batch.column("pieces")
            bounds = lists.offsets.to_numpy()
            all_h, all_at, all_hot = (
                lists.values.field(name).to_numpy(zero_copy_only=False)
                for name in ("h", "at", "hot"))
            found: list[bytes] = []
            for i, text in enumerate(texts):
                mine = slice(bounds[i], bounds[i + 1])
                h, at, hot = all_h[mine], all_at[mine], all_hot[mine].astype(bool)
                start, n = at >> 8, at & 0xFF
                end = start + n + window - 1
                found += symbols.contents(text, list(zip(
                    start[~hot].tolist(), end[~hot].tolist(), strict=True)))
                if hot.any():
                    yield _windows(int(docs[i]), int(ths[i]), text, h[hot], start[hot], n[hot],
                                   symbols)
            cold = np.flatnonzero(~all_hot[bounds[0]:bounds[-1]].astype(bool)) + bounds[0]
            owner = np.searchsorted(bounds, cold, side="right") - 1
            yield pa.record_batch({
                "h": all_h[cold], "dig": np.zeros(len(cold), np.int64),
                "doc": docs[owner], "th": ths[owner], "at": all_at[cold],
                "content": pa.array(found, pa.binary())})

    return saved(map_batches(rows.select("doc", "th", "text", "pieces"), read,
                             PIECE + ", content binary"), "contents")


def _windows(doc: int, th: int, text: bytes, h: np.ndarray, start: np.ndarray, n: np.ndarray,
             symbols: Symbols) -> pa.RecordBatch:
    """One row per window of pieces of one text."""
    keys = np.repeat(h, n)
    at = np.repeat(start, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    digest = np.zeros(len(at), np.int64)
    data = np.frombuffer(text, np.uint8)
    for values, bounds, _, base in symbols.sequences(data, np.array([0, len(data)])):
        seq = Sequence(values, bounds, symbols.window, symbols.gram, symbols.halves)
        for i, b in enumerate(base.tolist()):
            here = (at >= b) & (at + symbols.window <= b + bounds[i + 1] - bounds[i])
            digest[here] = seq.window_digests(at[here] - b + bounds[i])
    return pa.record_batch({
        "h": keys, "dig": digest, "doc": np.full(len(at), doc, np.int64),
        "th": np.full(len(at), th, np.int64), "at": _place(at, np.ones(len(at), np.int64)),
        "content": pa.nulls(len(at), pa.binary())})


def _not_earliest(rows: DataFrame, firsts: DataFrame) -> DataFrame:
    several = firsts.where("copies > 1").select("h", "dig", "first")
    return (rows.join(several, ["h", "dig"])
            .where(F.struct("doc", "th", "at") > F.col("first")).select("doc", "th", "at"))


def _firsts(rows: DataFrame, name: str) -> DataFrame:
    return saved(rows.groupBy("h", "dig").agg(
        F.min(F.struct("doc", "th", "at")).alias("first"), F.count(F.lit(1)).alias("copies")), name)


Index = Callable[[list[bytes]], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]


def _searched(contents: DataFrame, find: Index, limit: int) -> DataFrame:
    """Windows of the pieces in ``contents`` that a shard's index also has earlier.

    Pieces arrive sorted by key; a shard takes whole keys up to ``limit`` bytes.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def shard() -> pa.RecordBatch:
            held.sort(key=lambda r: r[1:4])  # earliest first
            piece, start, n = find([r[4] for r in held])
            doc, th, at = (np.array([r[k] for r in held], np.int64) for k in (1, 2, 3))
            begin = (at >> 8)[piece] + start
            return pa.record_batch({"doc": doc[piece], "th": th[piece], "at": _place(begin, n)})

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist()
                             for c in ("h", "doc", "th", "at", "content")), strict=True):
                if size >= limit and row[0] != held[-1][0]:
                    yield shard()
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield shard()

    cold = contents.where("content IS NOT NULL").select("h", "doc", "th", "at", "content")
    dealt = cold.repartition(partitions(cold.sparkSession), "h").sortWithinPartitions("h")
    return map_batches(dealt, search, "doc bigint, th bigint, at bigint")


def _once(source: DataFrame) -> DataFrame:
    """One row per ``(doc, th)``: copies of a row are no earlier place of one another,
    and their windows are the same.  Only rows that repeat are shuffled."""
    again = saved(source.groupBy("doc", "th").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                  .select("doc", "th"), "again")
    one = source.join(again, ["doc", "th"], "left_semi").groupBy("doc", "th") \
        .agg(F.min("text").alias("text"))
    return source.join(again, ["doc", "th"], "left_anti").unionByName(saved(one, "one"))


def repeated(docs: DataFrame, id_col: str, text_col: str, symbols: Symbols, find: Index, *,
             hot: int = 256, limit: int = 1 << 17) -> tuple[DataFrame, DataFrame]:
    """``(source, spans)``: the rows as ``(doc, th, text)`` and, for texts with
    repeats, ``(doc, th, starts)`` with runs of repeated window starts."""
    text = whole_text(text_col)
    source = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(1 << 63))).alias("doc"),
        F.xxhash64(text).alias("th"), text.alias("text"))
    once = _once(source)
    pieces = _pieces(once, symbols)
    counted = saved(pieces.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                    .select("h"), "counted")
    rows = saved(pieces.join(counted, "h"), "rows")
    firsts = _firsts(rows, "firsts")
    kinds = saved(firsts.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "kinds")
    wanted = saved(firsts.join(kinds, "h").select(
        "h", "first.doc", "first.th", "first.at", (F.col("n") > hot).alias("hot")), "wanted")
    contents = _contents(once, wanted, symbols)
    single = contents.where("content IS NULL").drop("content")
    found = [_not_earliest(rows, firsts), _searched(contents, find, limit),
             _not_earliest(single, _firsts(single, "window_firsts"))]
    hits = found[0].unionByName(found[1]).unionByName(found[2])
    spans = hits.groupBy("doc", "th").agg(F.collect_list("at").alias("starts"))
    return source, saved(spans, "spans")


def covered(starts: list[int] | None, window: int) -> list[tuple[int, int]]:
    """Maximal symbol ranges covered by runs of windows ``start << 8 | count``."""
    out: list[tuple[int, int]] = []
    for x in sorted(starts or ()):
        a, b = x >> 8, (x >> 8) + (x & 0xFF) - 1 + window
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def removal(docs: DataFrame, id_col: str, text_col: str, symbols: Symbols, find: Index,
            kept: Callable[[bytes, list[tuple[int, int]]], tuple[bytes, int]],
            **options) -> DataFrame:
    """``(doc_id, n, spans, kept)`` per input row."""
    source, spans = repeated(docs, id_col, text_col, symbols, find, **options)
    window = symbols.window
    rows = source.join(spans, ["doc", "th"], "left").select("doc", "text", "starts")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        ranges = [covered(x, window) for x in batch.column("starts").to_pylist()]
        done = [kept(t, r) for t, r in zip(texts, ranges, strict=True)]
        return pa.record_batch({
            "doc": batch.column("doc"), "n": pa.array([n for _, n in done], pa.int64()),
            "spans": pa.array([[{"start": a, "end": b} for a, b in r] for r in ranges],
                              pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            "kept": pa.array([k for k, _ in done], pa.binary())})

    out = map_rows(rows, cut, "doc bigint, n bigint, "
                              "spans array<struct<start:bigint,end:bigint>>, kept binary")
    kind = docs.schema[id_col].dataType
    return out.select(F.when(F.col("doc") != -(1 << 63), F.col("doc")).cast(kind).alias("doc_id"),
                      "n", "spans", "kept")
