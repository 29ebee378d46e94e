"""Token-id files with Elias-Fano coded document boundaries.

A token table is a folder of Parquet files; each row is a block of documents
in ascending id order:

``shard, block``   place of the block; shards are ranges of ids, in order
``start``          ids of the shard before this block
``doc_ids``        ids of the documents (NULL for a NULL id)
``bounds``         Elias-Fano code of the end of each document in ``ids``
``ids``            all token ids, little-endian, ``width`` bytes each

A block holds about ``block_ids`` ids, so neither writer nor reader ever holds
a shard; a longer document is a block of its own.
"""

from __future__ import annotations

import os
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crease.llm._common import map_batches, map_rows, partitions, whole_text, worker_memory
from crease.llm._text import groups, utf8
from crease.llm.pretokens import Memory, encode_plain


class EliasFano:
    """A non-decreasing sequence of integers from 0 in about ``2 + log2(u / n)``
    bits each: the low bits packed, the high bits as a unary bit vector."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        ones = np.bitwise_count(high).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)])  # ones before each word

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        each = (values[:, None] >> np.arange(low_bits)) & 1
        low = np.packbits(each.astype(np.uint8).ravel(), bitorder="little")
        high = np.zeros((n + (top >> low_bits)) // 64 * 64 + 64, np.uint8)
        high[(values >> low_bits) + np.arange(n)] = 1
        return cls(n, low_bits, low, np.packbits(high, bitorder="little").view("<u8"))

    def to_bytes(self) -> bytes:
        head = np.array([self.n, self.low_bits, len(self.low), len(self.high)], "<u8")
        return head.tobytes() + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, low_bits, low, high = (int(x) for x in np.frombuffer(data, "<u8", 4))
        return cls(n, low_bits, np.frombuffer(data, np.uint8, low, 32),
                   np.frombuffer(data, "<u8", high, 32 + low))

    def select(self, at: np.ndarray) -> np.ndarray:
        """The values at positions ``at``."""
        word = np.searchsorted(self.before, at, side="right") - 1
        rest = at - self.before[word]
        bits = self.high[word].copy()
        while (more := rest > 0).any():  # drop the lowest one until it is the wanted one
            bits[more] &= bits[more] - np.uint64(1)
            rest[more] -= 1
        lowest = bits & (~bits + np.uint64(1))
        place = word * 64 + np.bitwise_count(lowest - np.uint64(1)).astype(np.int64)
        value = (place - at) << self.low_bits
        for j in range(self.low_bits):
            bit = at * self.low_bits + j
            value |= ((self.low[bit >> 3] >> (bit & 7)) & 1).astype(np.int64) << j
        return value


class LibraryEncoder:
    """Ids from the tokenizers library, each distinct pre-token encoded once while
    it is remembered; texts that the tables of ``pretokens`` do not reach are
    encoded whole."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.direct = self._takes_words()
        self.memory = Memory(self._words)

    def _takes_words(self) -> bool:
        """Whether the file hands plain ASCII pre-tokens to its model as they are."""
        steps, split = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        signs = "".join(c for c in string.punctuation if c != "'")
        probes = [string.ascii_lowercase, signs, *string.ascii_lowercase, *string.digits, *signs,
                  *(2 * c for c in string.ascii_lowercase + signs)]
        return steps is not None and split is not None and all(
            steps.normalize_str(p) == p and [w for w, _ in split.pre_tokenize_str(p)] == [p]
            for p in probes)

    def _words(self, words: list[str]) -> list[list[int]]:
        """Ids of pre-tokens: the steps before the model leave those in ASCII as they are."""
        if not self.direct:
            return self._encode(words)
        tokenize = self.model.tokenize
        rest = iter(self._others([w for w in words if not w.isascii()]))
        return [[t.id for t in tokenize(w)] if w.isascii() else next(rest) for w in words]

    def _others(self, words: list[str]) -> list[list[int]]:
        """Ids of pre-tokens, the steps before the model taken for many at once where
        they find the same pre-tokens."""
        if not words:
            return []
        joined = " ".join(words)
        if self.tokenizer.normalizer.normalize_str(joined) == joined:
            found = self.tokenizer.pre_tokenizer.pre_tokenize_str(joined)
            if [joined[a:b] for _, (a, b) in found] == words:
                tokenize = self.model.tokenize
                return [[t.id for t in tokenize(piece)] for piece, _ in found]
        return self._encode(words)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        simple = [not any(s in t for s in self.special) for t in texts]
        done = iter(encode_plain([t for t, x in zip(texts, simple, strict=True) if x],
                                 self.memory))
        found = [next(done) if x else None for x in simple]
        rest = iter(self._encode([t for t, f in zip(texts, found, strict=True) if f is None]))
        return [np.array(next(rest), np.uint32) if f is None else f for f in found]


_encoders: dict[str, LibraryEncoder] = worker_memory("token_files")


def _encoder(name: str) -> LibraryEncoder:
    """The encoder of a file shipped with the application, built once per worker."""
    if name not in _encoders:
        _encoders[name] = LibraryEncoder(SparkFiles.get(name))
    return _encoders[name]


_BLOCK = "shard int, block int, start bigint, doc_ids array<bigint>, bounds binary, width int, " \
         "ids binary"


def write_token_files(docs: DataFrame, tokenizer_path: str, path: str, *,
                      id_col: str = "doc_id", text_col: str = "text", end_id: int = 1,
                      block_ids: int = 1 << 21, shards: int | None = None) -> None:
    """Encode every text, append ``end_id`` and write the token table at ``path``.

    NULL texts are empty documents (the end id alone).  Documents are in
    ascending id order, NULL ids first; rows that share an id are ordered by a
    checksum of their text, then by the text, and rows that are the same in both are all
    written.  Other columns are not read; an empty table gives a table without
    blocks.
    """
    spark = docs.sparkSession
    spark.sparkContext.addFile(tokenizer_path)
    name = tokenizer_path.rsplit("/", 1)[-1]
    text = whole_text(text_col)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc"),
                       F.crc32(text.cast("binary")).alias("tie"), text.alias("text"))
    # the checksum also splits a range of rows without an id
    ordered = (rows.repartitionByRange(shards or partitions(spark), "doc", "tie")
               .sortWithinPartitions("doc", "tie", "text")
               .select("doc", "text", F.spark_partition_id().alias("shard")))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(name)
        held: list[np.ndarray] = []
        doc_ids: list[int | None] = []
        size = start = block = shard = 0

        def flush() -> pa.RecordBatch:
            ends = np.cumsum([len(h) for h in held])
            ids = np.concatenate(held)
            width = 2 if ids.max(initial=0) < 1 << 16 else 4
            return pa.record_batch({
                "shard": pa.array([shard], pa.int32()), "block": pa.array([block], pa.int32()),
                "start": pa.array([start], pa.int64()),
                "doc_ids": pa.array([doc_ids], pa.list_(pa.int64())),
                "bounds": pa.array([EliasFano.of(ends).to_bytes()], pa.binary()),
                "width": pa.array([width], pa.int32()),
                "ids": pa.array([ids.astype(f"<u{width}").tobytes()], pa.binary())})

        for batch in batches:
            _, offsets = utf8(batch.column("text"))
            for a, b in groups(offsets):
                part = batch.slice(a, b - a)
                shard = part.column("shard")[0].as_py()
                for doc, ids in zip(part.column("doc").to_pylist(),
                                    encode(part.column("text").to_pylist()), strict=True):
                    if size and size + len(ids) + 1 > block_ids:
                        yield flush()
                        block, start = block + 1, start + size
                        held, doc_ids, size = [], [], 0
                    held.append(np.append(ids, np.uint32(end_id)))
                    doc_ids.append(doc)
                    size += len(ids) + 1
        if held:
            yield flush()

    map_batches(ordered, write, _BLOCK, "token_files").write.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of each document of a token table:
    ``start`` counts the ids of all documents before it, over all shards."""
    blocks = spark.read.parquet(path)

    def read(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: dict[str, list[np.ndarray]] = {"shard": [], "start": [], "n_tokens": [],
                                            "ids_crc32": []}
        docs: list[int | None] = []
        for row in batch.to_pylist():
            bounds = EliasFano.from_bytes(row["bounds"])
            ends = bounds.select(np.arange(bounds.n))
            begins = np.concatenate([[0], ends[:-1]])
            ids = np.frombuffer(row["ids"], f"<u{row['width']}").astype("<u4")
            docs += row["doc_ids"]
            out["shard"].append(np.full(bounds.n, row["shard"]))
            out["start"].append(begins + row["start"])
            out["n_tokens"].append(ends - begins)
            out["ids_crc32"].append(np.array(
                [zlib.crc32(ids[a:b]) for a, b in zip(begins, ends, strict=True)], np.int64))
        return pa.record_batch(
            {"doc_id": pa.array(docs, pa.int64())}
            | {k: pa.array(np.concatenate(v) if v else [], pa.int64()) for k, v in out.items()})

    # a few blocks at a time: each is some MB
    rows = map_rows(blocks, read, "doc_id bigint, shard bigint, start bigint, n_tokens bigint, "
                                  "ids_crc32 bigint")
    # one row per shard, as many as the writer had tasks
    total = blocks.groupBy("shard").agg(F.max(
        F.col("start") + F.octet_length("ids") / F.col("width")).cast("bigint").alias("n"))
    before = total.select("shard", F.coalesce(F.sum("n").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("before"))
    return rows.join(F.broadcast(before), "shard").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
