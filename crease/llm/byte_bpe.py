"""Byte-level BPE with rank files, pre-tokenised without a pattern engine.

Every code point has a class (letter, number, white space, other).  With a look
at the next characters each place of a text becomes one symbol of a small
machine, and each symbol is a transition function over its states.  Functions
compose associatively, and only a few dozen compositions are distinct, so they
are numbered and their products tabled; prefix products of a whole batch of
texts then come out of blocked scans, one table lookup a place.  The state
before a place and its symbol say whether a pre-token begins there.

The slices between boundaries feed pair merging by rank.  Pre-tokens are
remembered by their bytes, so no two can be taken for one another.  The byte
offset of each token is kept: a token decodes to the bytes from its offset to
the next one.
"""

from __future__ import annotations

import base64
import functools
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from crease.llm._common import map_batches, whole_text, worker_memory
from crease.llm._text import groups, utf8

# -- classes of code points

_LETTER, _NUMBER, _SPACE, _OTHER = range(4)
POINTS = 0x110000


@functools.cache
def classes() -> np.ndarray:
    """The class of each code point as the rank library's own patterns see it: its
    tables and Python's may be of different Unicode versions."""
    import tiktoken

    points = np.arange(POINTS, dtype="<u4")
    points[0xD800:0xE000] = 0  # no characters
    text = points.tobytes().decode("utf-32-le")
    kind = np.full(POINTS, _OTHER, np.uint8)
    single = {bytes([b]): b for b in range(256)}
    for cls, pattern in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_SPACE, r"\s")):
        probe = tiktoken.Encoding(f"probe {cls}", pat_str=pattern, mergeable_ranks=single,
                                  special_tokens={})
        found = bytes(probe.encode_ordinary(text)).decode()
        kind[np.frombuffer(found.encode("utf-32-le"), "<u4")] = cls
    return kind


# -- the machine

# States: what the place before it leaves open.
_NONE, _IN_LETTERS, _IN_NUMBERS, _IN_OTHERS, _IN_SPACE, _AFTER_BLANK, _ONE_MORE, _TWO_MORE = range(8)
STATES = 8
# Symbols: letter, number, other, white space that more of it or the end
# follows, the last blank (U+0020) before something else, the last other white
# space before something else, an apostrophe before a one- or two-letter ending.
(_SYM_LETTER, _SYM_NUMBER, _SYM_OTHER, _SYM_SPACE, _SYM_BLANK, _SYM_LAST, _SYM_SHORT,
 _SYM_LONG) = range(8)
SYMBOLS = 8
# The endings after an apostrophe that are pre-tokens of their own.
SHORT_ENDINGS = ("s", "t", "m", "d")
LONG_ENDINGS = ("re", "ve", "ll")


def _next_state() -> np.ndarray:
    """``[symbol, state]``: the state after the symbol."""
    to = np.empty((SYMBOLS, STATES), np.uint8)
    to[_SYM_LETTER] = _IN_LETTERS
    to[_SYM_LETTER, _TWO_MORE] = _ONE_MORE
    to[_SYM_LETTER, _ONE_MORE] = _NONE
    to[_SYM_NUMBER] = _IN_NUMBERS
    to[_SYM_OTHER] = _IN_OTHERS
    to[_SYM_SPACE] = _IN_SPACE
    to[_SYM_BLANK] = _AFTER_BLANK
    to[_SYM_LAST] = _NONE
    to[_SYM_SHORT], to[_SYM_LONG] = _ONE_MORE, _TWO_MORE
    # an apostrophe inside a run of others, or taken in by a blank, begins nothing
    to[_SYM_SHORT:, [_IN_OTHERS, _AFTER_BLANK]] = _IN_OTHERS
    return to


def _begins() -> np.ndarray:
    """``[symbol, state]``: whether a pre-token begins at the symbol."""
    begins = np.ones((SYMBOLS, STATES), bool)
    begins[_SYM_LETTER, [_IN_LETTERS, _AFTER_BLANK, _ONE_MORE, _TWO_MORE]] = False
    begins[_SYM_NUMBER, [_IN_NUMBERS, _AFTER_BLANK]] = False
    for symbol in (_SYM_OTHER, _SYM_SHORT, _SYM_LONG):
        begins[symbol, [_IN_OTHERS, _AFTER_BLANK]] = False
    begins[_SYM_SPACE, _IN_SPACE] = False
    return begins


BEGINS = _begins()


@functools.cache
def _monoid() -> tuple[np.ndarray, np.ndarray]:
    """``(product, value)``: ``product[a, b]`` numbers "first a, then b", and
    ``value[a, state]`` is function ``a``.  The first ``SYMBOLS`` functions are
    the symbols, the next the symbols at the start of a text, whatever was before."""
    step = _next_state()
    table = [tuple(f) for f in step.tolist()]
    table += [(f[_NONE],) * STATES for f in step.tolist()]
    known = {}
    for number, f in enumerate(table):
        known.setdefault(f, number)
    at = 0
    while at < len(table):
        for other in table[:2 * SYMBOLS]:
            f = tuple(other[s] for s in table[at])
            if f not in known:
                known[f] = len(table)
                table.append(f)
        at += 1
    value = np.array(table, np.uint8)
    product = np.array([[known[tuple(b[s] for s in a)] for b in table] for a in table], np.uint8)
    return product, value


def scan(functions: np.ndarray, block: int = 64) -> np.ndarray:
    """Inclusive prefix products of numbered functions: inside blocks side by side,
    then over the blocks' products in the same way, then both together."""
    product, _ = _monoid()
    n = len(functions)
    if n <= block:
        out = functions.copy()
        for i in range(1, n):
            out[i] = product[out[i - 1], out[i]]
        return out
    rows = -(-n // block)
    grid = np.zeros(rows * block, np.uint8)
    grid[:n] = functions
    grid = np.ascontiguousarray(grid.reshape(rows, block).T)  # one place of all blocks a row
    for i in range(1, block):
        grid[i] = product[grid[i - 1], grid[i]]
    before = scan(grid[-1], block)[:-1]
    grid[:, 1:] = product[before[None, :], grid[:, 1:]]
    return grid.T.reshape(-1)[:n]


def boundaries(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin in code points laid end to end; texts begin at
    ``starts`` (ascending, each below ``len(points)``)."""
    n = len(points)
    if n == 0:
        return np.zeros(0, np.int64)
    kind = classes()[points]
    first = np.zeros(n + 1, bool)
    first[starts] = True
    first[n] = True  # nothing follows
    symbol = kind.copy()
    symbol[kind == _LETTER] = _SYM_LETTER
    symbol[kind == _NUMBER] = _SYM_NUMBER
    symbol[kind == _OTHER] = _SYM_OTHER
    space = kind == _SPACE
    symbol[space] = _SYM_SPACE
    last = space.copy()
    last[:-1] &= ~space[1:]
    last &= ~first[1:]
    symbol[last] = np.where(points[last] == ord(" "), _SYM_BLANK, _SYM_LAST)
    quote = np.flatnonzero(points == ord("'"))
    quote = quote[~first[quote + 1]]
    follows = points[quote + 1]
    symbol[quote[np.isin(follows, [ord(e) for e in SHORT_ENDINGS])]] = _SYM_SHORT
    pair = ~first[np.minimum(quote + 2, n)]
    quote, follows = quote[pair], follows[pair]
    second = points[quote + 2]
    for ending in LONG_ENDINGS:
        symbol[quote[(follows == ord(ending[0])) & (second == ord(ending[1]))]] = _SYM_LONG
    number = symbol.copy()
    number[starts] += SYMBOLS
    _, value = _monoid()
    state = np.empty(n, np.uint8)
    state[0] = _NONE
    state[1:] = value[scan(number)[:-1], _NONE]
    state[starts] = _NONE
    return np.flatnonzero(BEGINS[symbol, state])


# -- ranks

#: pre-tokens of up to so many bytes are merged without a queue
SHORT = 48
NO_RANK = 1 << 32


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: lines of a token's bytes in base 64 and its rank, which is its id."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank)
                for token, rank in (line.split() for line in file if line.strip())}


class Pieces(dict):
    """Little-endian 32-bit ids of each pre-token seen, by its bytes.

    Starts anew at ``size`` bytes held; a pre-token longer than ``longest`` is not
    held, so a task's memory stays bounded whatever the texts."""

    def __init__(self, ranks: dict[bytes, int], size: int = 48 << 20, longest: int = 256):
        super().__init__()
        self.ranks, self.size, self.longest = ranks, size, longest
        self.token = {rank: token for token, rank in ranks.items()}
        self.held = 0

    def __missing__(self, piece: bytes) -> bytes:
        whole = self.ranks.get(piece)
        if whole is not None:
            ids = whole.to_bytes(4, "little")
        else:
            merge = self.merge_short if len(piece) <= SHORT else self.merge
            ids = array("I", merge(piece)).tobytes()
        if len(piece) <= self.longest:
            self.held += 200 + len(piece) + len(ids)
            if self.held > self.size:
                self.clear()
                self.held = 200 + len(piece) + len(ids)
            self[piece] = ids
        return ids

    def merge_short(self, piece: bytes) -> list[int]:
        """As ``merge``, in quadratic time but quicker for a few bytes: the ranks of
        all pairs that are left are in one list."""
        rank_of, none = self.ranks.get, NO_RANK
        cut = list(range(len(piece) + 1))
        rank = [rank_of(piece[i:i + 2], none) for i in range(len(piece) - 1)]
        while rank:
            least = min(rank)
            if least == none:
                break
            i = rank.index(least)
            del cut[i + 1], rank[i]
            if i < len(rank):
                rank[i] = rank_of(piece[cut[i]:cut[i + 2]], none)
            if i:
                rank[i - 1] = rank_of(piece[cut[i - 1]:cut[i + 1]], none)
        ranks = self.ranks
        return [ranks[piece[a:b]] for a, b in zip(cut, cut[1:], strict=False)]

    def merge(self, piece: bytes) -> list[int]:
        """Lowest rank first, leftmost among equal ones.

        ``end[i]`` is where the token that begins at byte ``i`` ends (0 once it is
        part of the one before), ``start[i]`` where the token that ends at byte
        ``i`` begins.  An entry of the queue is stale unless the two tokens at
        its place still make up its rank's bytes."""
        ranks, token, n = self.ranks, self.token, len(piece)
        end, start = list(range(1, n + 1)), list(range(-1, n))
        queue = []
        for i in range(n - 1):
            rank = ranks.get(piece[i:i + 2])
            if rank is not None:
                queue.append(rank << 32 | i)
        heapq.heapify(queue)
        while queue:
            entry = heapq.heappop(queue)
            i, rank = entry & 0xFFFFFFFF, entry >> 32
            middle = end[i]
            if not middle or middle == n or end[middle] - i != len(token[rank]):
                continue  # stale
            stop = end[middle]
            end[i], end[middle], start[stop] = stop, 0, i
            if stop < n:
                rank = ranks.get(piece[i:end[stop]])
                if rank is not None:
                    heapq.heappush(queue, rank << 32 | i)
            if i:
                left = start[i]
                rank = ranks.get(piece[left:stop])
                if rank is not None:
                    heapq.heappush(queue, rank << 32 | left)
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:end[i]]])
            i = end[i]
        return out


class ByteCodec:
    """Encoder and decoder of one rank file."""

    def __init__(self, ranks: dict[bytes, int]):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError("a rank file needs every single byte")
        self.pieces = Pieces(ranks)
        token = self.pieces.token
        strings = [token.get(i, b"") for i in range(max(token) + 1)]
        self.size = np.array([len(s) for s in strings], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(strings), np.uint8)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Little-endian 32-bit ids of each text, for UTF-8 texts laid end to end."""
        raw = data.tobytes()
        points = np.frombuffer(raw.decode().encode("utf-32-le"), "<u4")
        place = np.flatnonzero((data & 0xC0) != 0x80)  # first byte of each code point
        filled = offsets[:-1][offsets[1:] > offsets[:-1]]
        begin = place[boundaries(points, np.searchsorted(place, filled))]
        cut = [*begin.tolist(), len(raw)]
        pieces = self.pieces
        ids = [pieces[raw[a:b]] for a, b in zip(cut[:-1], cut[1:], strict=True)]
        to = np.searchsorted(begin, offsets).tolist()
        return [b"".join(ids[a:b]) for a, b in zip(to[:-1], to[1:], strict=True)]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, bytes]:
        """``(offsets, bytes)`` of ids laid end to end: token ``i`` is
        ``bytes[offsets[i]:offsets[i + 1]]``."""
        size = self.size[ids]
        offsets = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.begin[ids] - offsets[:-1], size) + np.arange(offsets[-1])
        return offsets, self.bytes[at].tobytes()


_codecs: dict[str, ByteCodec] = worker_memory("byte_bpe")


def codec_for(name: str) -> ByteCodec:
    """The codec of a file shipped with the application, built once per worker."""
    if name not in _codecs:
        _codecs[name] = ByteCodec(load_ranks(SparkFiles.get(name)))
    return _codecs[name]


def _ids(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column(name).fill_null(pa.scalar([], batch.column(name).type))
    flat = column.flatten()
    cut = np.concatenate([[0], np.cumsum(np.asarray(column.value_lengths()))]).astype(np.int64)
    return np.asarray(flat.fill_null(-1)), cut


def byte_bpe_encode(docs: DataFrame, ranks_path: str, *, text_col: str = "text") -> DataFrame:
    """``(row, token_ids, token_offsets, ids_bytes, decoded)``: each input row (a
    struct of all its columns), its token ids, the byte at which each token
    begins, the ids as little-endian 32-bit integers, and the bytes they decode to.

    NULL texts are encoded as the empty text: no ids, no offsets, no bytes.
    Texts of any length are encoded whole.  Rows are handled one by one, so
    repeated rows and ids give equal results; columns of any name are kept
    inside ``row``; an empty table stays empty.
    """
    spark = docs.sparkSession
    spark.sparkContext.addFile(ranks_path)
    name = ranks_path.rsplit("/", 1)[-1]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    given = rows.select("row", whole_text(F.col(f"row.`{text_col}`")).alias("text"))
    schema = StructType([*rows.schema.fields, StructField("token_ids", ArrayType(IntegerType())),
                         StructField("token_offsets", ArrayType(IntegerType())),
                         StructField("ids_bytes", BinaryType()), StructField("decoded", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_for(name)
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for a, b in groups(offsets):
                part = offsets[a:b + 1]
                coded = codec.encode(data[part[0]:part[-1]], part - part[0])
                ids = np.frombuffer(b"".join(coded), "<u4").astype(np.int32)
                cut = np.cumsum([0, *(len(c) // 4 for c in coded)])
                at, raw = codec.decode(ids)
                begin = at[cut]  # first byte of each text
                within = at[:-1] - np.repeat(begin[:-1], np.diff(cut))
                lists = pa.array(cut, pa.int32())
                yield pa.record_batch({
                    "row": batch.column("row").slice(a, b - a),
                    "token_ids": pa.ListArray.from_arrays(lists, pa.array(ids)),
                    "token_offsets": pa.ListArray.from_arrays(
                        lists, pa.array(within.astype(np.int32))),
                    "ids_bytes": pa.array(coded, pa.binary()),
                    "decoded": pa.array([raw[x:y] for x, y in
                                         zip(begin[:-1].tolist(), begin[1:].tolist(),
                                             strict=True)], pa.binary())})

    return map_batches(given, run, schema, "byte_bpe")


def byte_bpe_decode(coded: DataFrame, ranks_path: str, *, ids_col: str = "token_ids"
                    ) -> DataFrame:
    """``coded`` with ``decoded``: the bytes of its ids.  A NULL list, NULL ids and
    ids the file does not have decode to nothing."""
    spark = coded.sparkSession
    spark.sparkContext.addFile(ranks_path)
    name = ranks_path.rsplit("/", 1)[-1]
    given = coded.select(F.struct(*[F.col(f"`{c}`") for c in coded.columns]).alias("row"),
                         F.col(f"`{ids_col}`").cast("array<int>").alias("ids"))
    schema = StructType([given.schema["row"], StructField("decoded", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_for(name)
        for batch in batches:
            ids, cut = _ids(batch, "ids")
            known = (ids >= 0) & (ids < len(codec.size))
            at, raw = codec.decode(ids[known])
            begin = at[np.concatenate([[0], np.cumsum(known)])[cut]].tolist()
            yield pa.record_batch({
                "row": batch.column("row"),
                "decoded": pa.array([raw[x:y] for x, y in
                                     zip(begin[:-1], begin[1:], strict=True)], pa.binary())})

    out = map_batches(given, run, schema, "byte_bpe")
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in coded.columns if c != "decoded"],
                      "decoded")
