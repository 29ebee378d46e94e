"""Format-agnostic layer IO: raw ingest, table reads, audited writes."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from crease.plans.jobs import run_together
from crease.sources.tables import commit_part, has_batch, load, new_part, write_bucketed

# headers of files read at the same time
HEADER_JOBS = 16

# audit columns each layer's sink appends (never part of the transforms)
AUDIT_COLUMNS = {
    "bronze": {"ingested_at": F.current_timestamp, "pipeline_date": F.current_date},
    "silver": {"processed_at": F.current_timestamp},
    "gold": {"gold_created_at": F.current_timestamp},
}

# holds the raw line of a CSV record whose values do not fit the schema
MALFORMED = "_corrupt_record"


def csv_columns(spark: SparkSession, path: str, **options: str) -> list[str]:
    """The names in the header of a CSV file (one line is read)."""
    return spark.read.options(**options).option("header", "true").csv(path).columns


def literal(path: str) -> str:
    """A path as a pattern that matches nothing else."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def csv_groups(spark: SparkSession, path: str | list[str], **options: str
               ) -> dict[tuple[str, ...], list[str]]:
    """The CSV files of a folder, pattern or list, by their header.

    Listing reads no content; each file costs one job that reads its first line,
    several at a time.  Files without a byte have no header and are left out.
    """
    files = [literal(r["path"]) for r in spark.read.format("binaryFile").load(path)
             .where("length > 0").select("path").orderBy("path").toLocalIterator()]
    headers = run_together({f: (lambda f=f: tuple(csv_columns(spark, f, **options)))
                            for f in files}, HEADER_JOBS)
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, header in headers.items():
        groups.setdefault(header, []).append(file)
    return groups


def bound_schema(header: list[str], schema: StructType, required: list[str]) -> StructType:
    """``schema`` in the order of ``header``; columns it does not know are text.

    Raises if a required column is missing."""
    missing = [c for c in required if c not in header]
    if missing:
        raise ValueError(f"missing columns in the input: {', '.join(missing)}")
    known = {f.name: f for f in schema.fields}
    return StructType([known.get(c, StructField(c, StringType())) for c in header])


def by_name(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema`` by name; the ones ``df`` lacks are NULL."""
    extra = [MALFORMED] if MALFORMED in df.columns else []
    return df.select(*[
        F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields], *extra)


def ingest(spark: SparkSession, path: str | list[str], schema: StructType | None = None,
           fmt: str = "csv", required: list[str] | None = None, **options: str) -> DataFrame:
    """Read raw files: a file, a folder, a pattern or a list of them.

    CSV has a header and its columns are bound by name, file by file: files may
    order them differently and may lack columns that are not ``required``
    (default: the first column of the schema), which are then NULL.  Files of one
    header are one scan, and the scans are united by name.  A record with a
    value that does not fit its column's type keeps its raw line in
    ``_corrupt_record``.  With ``schema=None`` types are inferred (an extra
    pass) and all files must share one header.
    """
    reader = spark.read.format(fmt).options(**options)
    if fmt != "csv":
        return (reader.schema(schema) if schema is not None else reader).load(path)
    if schema is None:
        return reader.option("header", "true").option("inferSchema", "true").load(path)
    required = required or [schema.fields[0].name]
    raw = StructType([*schema.fields, StructField(MALFORMED, StringType())])
    scans = []
    for header, files in csv_groups(spark, path, **options).items():
        try:
            bound = bound_schema(list(header), schema, required)
        except ValueError as error:
            raise ValueError(f"{error} ({files[0]})") from None
        read = (spark.read.options(**options).option("header", "true")
                .option("columnNameOfCorruptRecord", MALFORMED)
                .schema(StructType([*bound.fields, raw[MALFORMED]])).csv(files))
        scans.append(by_name(read, schema))
    return reduce(DataFrame.union, scans) if scans else spark.createDataFrame([], raw)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               version: int | None = None) -> DataFrame:
    """A table as its latest complete version has it, or an earlier ``version``; a table
    written in place by others is read as it is."""
    return load(spark, path, fmt, version)


def with_audit(df: DataFrame, layer: str) -> DataFrame:
    return df.withColumns({name: fn() for name, fn in AUDIT_COLUMNS[layer].items()})


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None, buckets: Sequence = (),
                made_from: dict[str, int] | None = None) -> int:
    """Write ``df`` and return its row count, observed during the same job.

    The data goes to a new part of the table, and a commit (see ``tables``) makes
    it the table's content (``overwrite``) or adds it (``append``): readers get
    a whole version at any time, also when a write fails at whatever step.
    ``tables.expire`` removes what old versions leave.

    ``buckets`` (``[number, column, ...]``, in place of ``partition_by``) deals the rows
    by a hash of the columns, so that joins and groupings on them need no
    shuffle when the table is read; a column that one value fills makes one
    bucket large.
    """
    return observed_write(df, path, fmt, mode, partition_by, buckets=buckets,
                          made_from=made_from)["rows"]


def observed_write(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                   partition_by: list[str] | None = None,
                   batch: tuple[str, int] | None = None, buckets: Sequence = (),
                   values: Sequence = (), made_from: dict[str, int] | None = None
                   ) -> dict[str, int]:
    """As ``write_table``; with ``_corrupt_record`` among the columns, also counts
    the ``malformed`` records in the same job.

    ``batch`` is a stream's name and the number of its batch: a batch that the
    table holds already is not written again (0 rows).  Mode ``replace`` puts ``df`` in
    place of the rows whose partition column has one of ``values``."""
    if mode not in ("overwrite", "append", "replace"):
        raise ValueError(f"unknown mode {mode!r}")
    spark, folder, obs = df.sparkSession, path.rstrip("/"), Observation()
    counts = [F.count(F.lit(1)).alias("rows")]
    if MALFORMED in df.columns:
        counts.append(F.count(MALFORMED).alias("malformed"))
    if batch and has_batch(spark, folder, batch):
        return {"rows": 0} | ({"malformed": 0} if len(counts) > 1 else {})
    part = new_part()
    if buckets:
        # dealt here, unless the rows come dealt by the same columns and number
        dealt = df.repartition(buckets[0], *buckets[1:])
        write_bucketed(dealt.observe(obs, *counts), f"{folder}/{part}", fmt, buckets)
    else:
        writer = df.observe(obs, *counts).write.format(fmt).mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.save(f"{folder}/{part}")
    commit_part(spark, folder, part, mode, batch=batch,
                partition_by=() if buckets else partition_by or (), buckets=buckets,
                values=values, made_from=made_from, schema=df.schema.json())
    return {name: int(n) for name, n in obs.get.items()}
