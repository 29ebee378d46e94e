"""Spark helpers shared by the text operators."""

from __future__ import annotations

import atexit
import ctypes
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from crease.session import ensure_checkpoint_dir

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def work_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/crease-llm/{uuid.uuid4().hex}/{name}"


def saved(df: DataFrame, name: str = "step") -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read back.

    Cuts the lineage: a lost executor costs the tasks of one step only, and a
    table that is read twice is computed once.  The step's own shuffle files
    are released when the write ends.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    try:
        spark.conf.set(_CLEANUP, "true")
    except PySparkException:  # not a runtime setting of this Spark version
        before = None
    try:
        df.write.parquet(path)
    finally:
        if before is not None:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_text(text: str | Column) -> Column:
    """The text column with NULL as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that
    they need not have it installed."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    root, name = os.path.split(package)
    # on the driver alone: Spark's file server hands it to the executors
    folder = tempfile.mkdtemp(prefix="crease-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    staged = os.path.join(folder, "staged")
    shutil.copytree(package, os.path.join(staged, name),
                    ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(os.path.join(folder, name), "zip", staged))
    _shipped.add(sc.applicationId)


_memories: dict[str, dict] = {}


def worker_memory(name: str) -> dict:
    """What an operator remembers in a worker from one of its tasks to the next."""
    return _memories.setdefault(name, {})


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str | StructType, memory: str | None = None) -> DataFrame:
    """``fn`` over the Arrow batches of each partition.  A worker forgets what other
    operators remember in it; this one's ``memory`` stays."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget(memory)
        yield from fn(batches)
        trim()

    return df.mapInArrow(run, schema)


def forget(keep: str | None) -> None:
    others = [held for name, held in _memories.items() if name != keep and held]
    for held in others:
        held.clear()
    if others:
        trim()


def trim() -> None:
    """Give memory that is free back to the system: Spark keeps its Python workers, and
    what one step leaves free in them counts against the steps after it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


def map_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch],
             schema: str | StructType) -> DataFrame:
    """``fn`` over Arrow batches, one batch in, one batch out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield fn(batch)

    return map_batches(df, run, schema)
