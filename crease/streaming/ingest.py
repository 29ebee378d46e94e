"""Append newly landed raw files to a bronze table, exactly once per file."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from crease.sources.files import ingest, literal, observed_write, with_audit

# the columns of a stream of files; ``content`` is not read unless asked for
_FILES = "path string, modificationTime timestamp, length long, content binary"


def ingest_new_files(spark: SparkSession, source: str, schema: StructType, target: str,
                     name: str, fmt: str = "csv", table_format: str = "parquet",
                     checkpoint: str | None = None, required: list[str] | None = None) -> int:
    """Process every file in ``source`` not yet ingested, then stop.

    The stream carries the names of new files alone; each batch reads its files
    as ``sources.ingest`` does, so CSV files of one run may have different
    headers, and a file that lacks a ``required`` column fails the run.  The
    stream's progress lives in ``checkpoint`` (default:
    ``<spark.checkpoint.dir>/streams/<name>``, the shared folder the session
    names), so a rerun, in this session or a later one, resumes.  A batch that
    is run again after a failure, with the same files, is recognised by its
    number in the table's commits and not added twice.  Returns the rows
    appended by this run; read the table with ``sources.read_table``.
    """
    if checkpoint is None:
        # the configured folder itself: the context's own checkpoint dir gets a
        # fresh random suffix per session and would forget the stream's progress
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            raise ValueError("pass checkpoint= or set spark.checkpoint.dir")
        checkpoint = f"{base.rstrip('/')}/streams/{name}"
    added: list[int] = []

    def append(files: DataFrame, batch: int) -> None:
        paths = [r["path"] for r in files.select("path").collect()]
        if not paths:
            return
        # a stream begun anew in a new checkpoint counts its batches from 0 again
        stream = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        rows = with_audit(ingest(spark, [literal(p) for p in paths], schema, fmt, required),
                          "bronze")
        added.append(observed_write(rows, target, table_format, "append",
                                    batch=(stream, batch))["rows"])

    query = (spark.readStream.format("binaryFile").schema(_FILES).load(source).select("path")
             .writeStream.foreachBatch(append)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .queryName(f"ingest_{name}")
             .start())
    query.awaitTermination()
    return sum(added)
