"""Byte-pair encoding and decoding with the files of public tokenizers.

Encoding follows the tokenizer file: special tokens are cut out of the raw
text, the rest is normalised (NFC, white space to one space, lower case),
split by the file's pattern, mapped to byte symbols and merged.  Merging keeps
the symbols of a word in a doubly linked list and the possible merges in a
priority queue by rank and place; entries whose symbols have changed since
are stale and skipped when they come up.  Decoding concatenates the strings of
the vocabulary, with the space that separates tokens where the file names no
decoder.

Each distinct pre-token is merged once while a worker remembers it.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from crease.llm._common import map_batches, worker_memory
from crease.llm._text import groups, utf8
from crease.llm.pretokens import Memory, encode_plain, spread

#: distinct chunks remembered by a task before the memory starts anew
REMEMBERED = 20_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level files."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


class Remembered:
    """A dictionary of the entries used last, twice ``size`` at most."""

    def __init__(self, size: int = REMEMBERED):
        self.size = size
        self.young: dict = {}
        self.old: dict = {}

    def get(self, key):
        got = self.young.get(key)
        if got is None:
            got = self.old.get(key)
            if got is not None:
                self[key] = got
        return got

    def __setitem__(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value


class Codec:
    """Encoder and decoder for one tokenizer file (BPE over byte symbols)."""

    def __init__(self, spec: dict):
        model = spec["model"]
        if model["type"] != "BPE":
            raise ValueError(f"a BPE file is needed, not {model['type']}")
        self.vocab: dict[str, int] = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        self._rank_of: dict[int, int] = {}
        self._made: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self._rank_of[self.vocab[left] << 32 | self.vocab[right]] = rank
            self._made.append(self.vocab[left + right])
        self._byte = [self.vocab[s] for s in byte_symbols()]
        self._last = [self.vocab[s + suffix] for s in byte_symbols()]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in self.vocab.items()} | {
            i: s for s, i in self.special.items()}
        longest = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, longest))) if longest else None
        self.steps = [self._step(s) for s in (spec.get("normalizer") or {}).get("normalizers", [])]
        splits = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"]
                  if p["type"] == "Split"]
        self.pattern = regex.compile(splits[0])
        self.joint = "" if spec.get("decoder") else " "
        self._words: Remembered = Remembered()

    @staticmethod
    def _step(step: dict) -> Callable[[str], str]:
        if step["type"] == "NFC":
            return lambda text: text if text.isascii() else unicodedata.normalize("NFC", text)
        if step["type"] == "Replace":
            found, new = regex.compile(step["pattern"]["Regex"]), step["content"]
            return lambda text: found.sub(new, text)
        if step["type"] == "Lowercase":
            # character by character: no rule looks at the neighbours
            return lambda text: text.lower() if text.isascii() else "".join(map(str.lower, text))
        raise ValueError(f"unknown normaliser {step['type']}")

    def normalise(self, text: str) -> str:
        for step in self.steps:
            text = step(text)
        return text

    def merge(self, word: str) -> tuple[int, ...]:
        """The ids of one pre-token.

        ``symbol[i]`` starts at byte ``i`` (-1 once merged into its left
        neighbour), ``after`` and ``before`` link the symbols that are left.  A
        queue entry is rank and place in one integer; ranks name their pair, so
        an entry is stale unless the pair that is there now has its rank.
        """
        known = self._words.get(word)
        if known is not None:
            return known
        raw = word.encode()
        symbol = [self._byte[b] for b in raw]
        symbol[-1] = self._last[raw[-1]]
        n = len(symbol)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank_of, made = self._rank_of, self._made
        queue = []
        for at in range(n - 1):
            rank = rank_of.get(symbol[at] << 32 | symbol[at + 1])
            if rank is not None:
                queue.append(rank << 32 | at)
        heapq.heapify(queue)
        while queue:
            entry = heapq.heappop(queue)
            at, rank = entry & 0xFFFFFFFF, entry >> 32
            gone = after[at]
            if symbol[at] < 0 or gone == n or \
                    rank_of.get(symbol[at] << 32 | symbol[gone]) != rank:
                continue  # stale
            symbol[at], symbol[gone] = made[rank], -1
            right = after[at] = after[gone]
            if right < n:
                before[right] = at
                rank = rank_of.get(symbol[at] << 32 | symbol[right])
                if rank is not None:
                    heapq.heappush(queue, rank << 32 | at)
            left = before[at]
            if left >= 0:
                rank = rank_of.get(symbol[left] << 32 | symbol[at])
                if rank is not None:
                    heapq.heappush(queue, rank << 32 | left)
        ids = tuple([s for s in symbol if s >= 0])
        self._words[word] = ids
        return ids

    def chunk(self, raw: str) -> list[int]:
        """Ids of a text without the white space that splits it, or with."""
        if not self.cut or not self.cut.search(raw):
            return self._plain(raw)
        ids: list[int] = []
        at = 0
        for found in self.cut.finditer(raw):
            ids += self._plain(raw[at:found.start()])
            ids.append(self.special[found.group()])
            at = found.end()
        return ids + self._plain(raw[at:])

    def _plain(self, raw: str) -> list[int]:
        return [i for word in self.pattern.findall(self.normalise(raw)) for i in self.merge(word)]

    def decode(self, ids: Iterable[int]) -> str:
        strings = self.strings
        return self.joint.join([strings[i] for i in ids if i in strings])


def load(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def chunks(text: str) -> list[str]:
    """Pieces between white space that every step above drops; no special token
    holds any.  Runs of it leave empty pieces, which have no ids."""
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")


class Encoder:
    """Encodes whole texts, each distinct pre-token once while it is remembered."""

    def __init__(self, codec: Codec):
        self.codec = codec
        self.memory = Memory(lambda words: [codec.merge(w) for w in words])
        self.chunks = Remembered()
        strings = [s.encode() + codec.joint.encode() for s in
                   (codec.strings.get(i, "") for i in range(max(codec.strings) + 1))]
        self.size = np.array([len(s) for s in strings], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(strings), np.uint8)

    def slow(self, text: str) -> np.ndarray:
        """The ids of one text by all steps of the file, chunk by chunk."""
        ids: list[int] = []
        for chunk in chunks(text):
            got = self.chunks.get(chunk)
            if got is None:
                got = self.chunks[chunk] = tuple(self.codec.chunk(chunk))
            ids += got
        return np.array(ids, np.uint32)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        cut = self.codec.cut
        special = [bool(cut and cut.search(t)) for t in texts]
        done = iter(encode_plain([t for t, x in zip(texts, special, strict=True) if not x],
                                 self.memory))
        found = [None if x else next(done) for x in special]
        return [self.slow(t) if f is None else f for t, f in zip(texts, found, strict=True)]

    def decoded(self, ids: list[np.ndarray]) -> list[bytes]:
        """The strings of the ids of each text, one after the other."""
        flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        size = self.size[flat]
        raw = self.bytes[spread(self.begin[flat], size)].tobytes()
        ends = np.concatenate([[0], np.cumsum(size)])[np.cumsum([0, *map(len, ids)])].tolist()
        last = len(self.codec.joint)  # follows each string here, but joins them there
        return [raw[a:max(a, b - last)] for a, b in zip(ends[:-1], ends[1:], strict=True)]


#: text encoded at once; bounds the arrays per character
GROUP_BYTES = 1 << 18

_encoders: dict[str, Encoder] = worker_memory("bpe")


def encoder_for(name: str) -> Encoder:
    """The encoder of a file shipped with the application, built once per worker."""
    if name not in _encoders:
        _encoders[name] = Encoder(Codec(load(SparkFiles.get(name))))
    return _encoders[name]


def bpe_encode(docs: DataFrame, tokenizer_path: str, *, text_col: str = "text") -> DataFrame:
    """``(row, token_ids, decoded)``: each input row (a struct of all its
    columns), its token ids and the decoded text.

    NULL texts are encoded as the empty text: no ids, empty decoded text.  Rows
    are handled one by one, so repeated rows and ids give equal results;
    columns of any name are kept inside ``row``; an empty table stays empty.
    """
    spark = docs.sparkSession
    spark.sparkContext.addFile(tokenizer_path)
    name = tokenizer_path.rsplit("/", 1)[-1]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    place = docs.columns.index(text_col)
    schema = StructType([*rows.schema.fields, StructField("token_ids", ArrayType(IntegerType())),
                         StructField("decoded", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder_for(name)
        for batch in batches:
            text = pc.struct_field(batch.column("row"), place).cast(pa.string())
            _, offsets = utf8(text)
            for a, b in groups(offsets, GROUP_BYTES):
                ids = encode(text.slice(a, b - a).fill_null("").to_pylist())
                yield pa.record_batch({
                    "row": batch.column("row").slice(a, b - a),
                    "token_ids": pa.ListArray.from_arrays(
                        pa.array(np.cumsum([0, *map(len, ids)]), pa.int32()),
                        pa.array(np.concatenate(ids).astype(np.int32))),
                    "decoded": pa.array(encode.decoded(ids), pa.binary()).cast(pa.string())})

    return map_batches(rows, run, schema, "bpe")
