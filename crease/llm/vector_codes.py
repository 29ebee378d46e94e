"""Product codes of vectors, exact in integers.

A vector is scaled and floored to integers and cut into equal parts; each part
is replaced by the number of the nearest entry in its codebook.  Distances are
``|x|^2 - 2 x.c + |c|^2``, so the work is one matrix product per part.  BLAS
multiplies in float64, which is exact only below 2^53: integers are split into
limbs of so few bits that no sum of products can pass it, each pair of limbs
is one product, and the products are shifted and added up in int64.  The first
smallest distance wins, whatever the machine.

Codebooks are refined by Spark rounds: tasks add up the parts of each entry,
one aggregation joins their sums, and the driver holds nothing but the
codebooks themselves (``entries`` x width integers).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from crease.llm._common import map_batches, saved

#: rows multiplied at once
ROWS = 4096


def limbs(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """``values`` as float64 matrices with ``sum(limb[i] << (bits * i))`` = values;
    all but the last are in ``[0, 2^bits)``, the last one has the sign."""
    most = int(np.abs(values).max(initial=0)).bit_length()
    out = []
    for _ in range(max(1, -(-most // bits)) - 1):
        out.append((values & ((1 << bits) - 1)).astype(np.float64))
        values = values >> bits
    return [*out, values.astype(np.float64)]


def limb_bits(width: int) -> int:
    """Bits of a limb so that sums of ``width`` products stay within 2^53."""
    return (53 - max(1, width).bit_length()) // 2


def limb_products(left: list[np.ndarray], right: list[np.ndarray], bits: int) -> np.ndarray:
    """``a @ b.T`` from the limbs of both, exact if the results fit int64."""
    out = np.zeros((len(left[0]), len(right[0])), np.int64)
    for i, x in enumerate(left):
        for j, y in enumerate(right):
            shift = bits * (i + j)
            if shift < 64:  # beyond it nothing is left of a result that fits
                out += (x @ y.T).astype(np.int64) << shift
    return out


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` of int64 matrices by float64 BLAS, exact if the results fit int64."""
    bits = limb_bits(a.shape[1])
    return limb_products(limbs(a, bits), limbs(b, bits), bits)


def usable(vector: str | Column) -> Column:
    """Not NULL, not empty, every component there and finite."""
    column = F.col(vector) if isinstance(vector, str) else vector
    return F.coalesce(
        (F.size(column) > 0) & F.forall(
            column, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf")))),
        F.lit(False))


def integers(column: pa.Array, width: int, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of a list column without NULLs, one row per vector."""
    if len(column) == 0:
        return np.zeros((0, width), np.int64)
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64)
    flat = np.floor(scale * flat)
    # sums of squared differences over a whole vector stay below 2^63
    if np.abs(flat).max(initial=0) >= 2.0 ** ((61 - width.bit_length()) // 2):
        raise ValueError("a component is too large for exact distances in 64 bits")
    return flat.astype(np.int64).reshape(-1, width)


@dataclass(frozen=True)
class Codebooks:
    """``books[p][e]``: the integers of entry ``e`` of part ``p``."""

    books: np.ndarray  # parts x entries x width of a part, int64
    scale: int

    @property
    def parts(self) -> int:
        return self.books.shape[0]

    @property
    def width(self) -> int:
        return self.parts * self.books.shape[2]

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry numbers and squared distances of the parts of each vector."""
        pieces = vectors.reshape(len(vectors), self.parts, -1)
        codes = np.zeros((len(vectors), self.parts), np.uint8)
        errors = np.zeros((len(vectors), self.parts), np.int64)
        for p, book in enumerate(self.books):
            x = pieces[:, p]
            distance = exact_products(x, book)
            distance *= -2
            distance += (book * book).sum(axis=1)
            codes[:, p] = distance.argmin(axis=1)  # the first of equal ones
            errors[:, p] = distance[np.arange(len(x)), codes[:, p]] + (x * x).sum(axis=1)
        return codes, errors

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        """The integers that stand for rows of entry numbers."""
        return np.concatenate([book[codes[:, p]] for p, book in enumerate(self.books)], axis=1)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def train(rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding",
          parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256
          ) -> Codebooks | None:
    """Codebooks of the usable vectors, or None if there are none.

    They start as the parts of the ``entries`` vectors with the smallest ids
    (NULL ids last, equal ids by content; fewer rows give fewer entries).  Each
    round assigns all rows and replaces an entry by the floored mean of its
    parts; an entry without any stays.  A vector is usable if it is not NULL
    or empty, all its components are finite, and it is as long as the one with
    the smallest id.  ``entries`` is at most 256, and ``parts`` must divide the
    width; components that are too large for exact 64-bit distances raise.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be 1 to 256")
    given = rows.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").alias("v"))
    given = given.where(usable("v"))
    order = [F.col("id").asc_nulls_last(), F.col("v")]
    first = given.orderBy(*order).limit(1).collect()
    if not first:
        return None
    width = len(first[0]["v"])
    if width % parts:
        raise ValueError(f"{parts} equal parts do not fit a width of {width}")
    given = given.where(F.size("v") == width)
    seeds = given.orderBy(*order).limit(entries).collect()  # as many rows as entries
    start = np.floor(scale * np.array([r["v"] for r in seeds], np.float64)).astype(np.int64)
    books = start.reshape(len(seeds), parts, -1).transpose(1, 0, 2)
    piece = width // parts

    for _ in range(rounds):
        now = Codebooks(books, scale)

        def add_up(batches: Iterator[pa.RecordBatch], now: Codebooks = now
                   ) -> Iterator[pa.RecordBatch]:
            n_books = now.books.shape[1]
            count = np.zeros((parts, n_books), np.int64)
            total = np.zeros((parts, n_books, piece), np.int64)
            for batch in _slices(batches):
                vectors = integers(batch.column("v"), width, scale)
                codes, _ = now.nearest(vectors)
                for p in range(parts):
                    count[p] += np.bincount(codes[:, p], minlength=n_books)
                    np.add.at(total[p], codes[:, p], vectors[:, p * piece:(p + 1) * piece])
            part, entry = np.nonzero(count)
            yield pa.record_batch({
                "part": pa.array(part, pa.int32()), "entry": pa.array(entry, pa.int32()),
                "n": pa.array(count[part, entry]),
                "sums": pa.FixedSizeListArray.from_arrays(
                    pa.array(total[part, entry].ravel()), piece).cast(pa.list_(pa.int64()))})

        sums = map_batches(given.select("v"), add_up,
                           "part int, entry int, n bigint, sums array<bigint>")
        means = sums.groupBy("part", "entry").agg(
            F.sum("n").alias("n"),
            F.array(*[F.sum(F.col("sums")[i]) for i in range(piece)]).alias("sums"))
        books = books.copy()
        for row in means.collect():  # parts x entries rows
            books[row["part"], row["entry"]] = np.array(row["sums"], np.int64) // row["n"]
    return Codebooks(books, scale)


def encode(rows: DataFrame, codebooks: Codebooks, *, vector_col: str = "embedding") -> DataFrame:
    """``(row, code, error)``: each input row (a struct of all its columns) with a
    usable vector, two hex digits a part, and the squared distance to the
    vector its code stands for.

    Rows whose vector is NULL, empty, of another width or holds a NULL or
    non-finite component are left out.  Repeated rows and ids are encoded one
    by one; columns of any name are kept inside ``row``.
    """
    columns = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    given = (rows.where(usable(F.col(f"`{vector_col}`")))
             .where(F.size(f"`{vector_col}`") == codebooks.width)
             .select(columns.alias("row"), F.col(f"`{vector_col}`").alias("v")))
    schema = StructType([given.schema["row"], StructField("code", StringType()),
                         StructField("error", LongType())])
    digits = 2 * codebooks.parts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            codes, errors = codebooks.nearest(
                integers(batch.column("v"), codebooks.width, codebooks.scale))
            text = codes.tobytes().hex()
            yield pa.record_batch({
                "row": batch.column("row"),
                "code": pa.array([text[a:a + digits] for a in range(0, len(text), digits)],
                                 pa.string()),
                "error": pa.array(errors.sum(axis=1))})

    return map_batches(given, run, schema)


def decode(coded: DataFrame, codebooks: Codebooks) -> DataFrame:
    """``coded`` with ``decoded``: the integers that each ``code`` stands for.

    A NULL code, or one that is not two digits of a known entry a part, gives NULL.
    """
    columns = [F.col(f"`{c}`") for c in coded.columns]
    given = coded.select(F.struct(*columns).alias("row"), F.col("code").alias("c"))
    entries = codebooks.books.shape[1]

    def numbers(code: str | None) -> bytes | None:
        try:
            found = bytes.fromhex(code or "")
        except ValueError:
            return None
        return found if len(found) == codebooks.parts and max(found) < entries else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            codes = [numbers(c) for c in batch.column("c").to_pylist()]
            known = np.frombuffer(b"".join(c for c in codes if c), np.uint8)
            found = iter(codebooks.vectors(known.reshape(-1, codebooks.parts)))
            yield pa.record_batch({
                "row": batch.column("row"),
                "decoded": pa.array([next(found) if c else None for c in codes],
                                    pa.list_(pa.int64()))})

    out = map_batches(given, run, StructType([
        given.schema["row"],
        *StructType.fromDDL("decoded array<bigint>").fields]))
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in coded.columns if c != "decoded"],
                      "decoded")


def compress(rows: DataFrame, *, label_col: str = "label", **options) -> DataFrame:
    """``encode`` with codebooks trained on ``rows``, plus ``label_error``, the sum of
    the errors of all rows with an equal label (NULLs together), and
    ``codebooks_sha256``.  An empty table gives no rows."""
    vector_col = options.get("vector_col", "embedding")
    codebooks = train(rows, **options)
    if codebooks is None:
        codebooks = Codebooks(np.zeros((1, 1, 1), np.int64), 1)
        rows = rows.where(F.lit(False))
    coded = saved(encode(rows, codebooks, vector_col=vector_col), "codes")
    label = F.col(f"row.`{label_col}`")
    # partial sums before the shuffle: a label may hold any share of the rows
    totals = coded.groupBy(label.alias("l")).agg(F.sum("error").alias("label_error"))
    return (coded.join(totals, label.eqNullSafe(F.col("l")))
            .select("row", "code", "error", "label_error",
                    F.lit(codebooks.sha256()).alias("codebooks_sha256")))
