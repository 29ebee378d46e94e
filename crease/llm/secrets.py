"""Secret scans over an incremental ledger of text blobs (DataFrame operations only).

Every text is a blob named by its content.  A ledger table holds, for each
scanned blob and version of the rules, the findings.  A run scans only blobs
that the ledger does not have for the given version, appends them, and joins
the findings back to every row that holds the blob, so thousands of copies or
unchanged versions cost one scan.

``stored_scan`` keeps the ledger as a table: each run adds its rows as a folder of
its own, so a run that dies leaves no half rows and two runs at once at most scan
a blob twice.

Positions come without a user function: the texts between matches (``split``)
and the matches (``regexp_extract_all``) alternate, so their lengths give each
start and end in code points.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crease.llm._common import saved, whole_text

RULES_VERSION = 1

_WORDS = "password|passwd|secret|token|api_?key"

#: kind, pattern, the group that is measured, its least length; in report order
BASE_RULES = [
    ("assign", rf"""((?i)(?:{_WORDS}))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"(AKIA[A-Z0-9]{12,})", 1, 16),
    ("hex", r"([0-9a-f]{32,}+)", 1, 32),
]
MORE_RULES = [
    ("pem", r"(-----BEGIN [A-Z ]*PRIVATE KEY-----)", 1, 1),
    ("github", r"(gh[pousr]_[A-Za-z0-9]{36,})", 1, 40),
    ("jwt", r"(eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})", 1, 1),
]

_SPAN = "array<struct<start:bigint,rank:int,kind:string,end:bigint>>"


_LEDGER = f"blob binary, version int, spans {_SPAN}"


def _spans(rank: int, kind: str, pattern: str, group: int, least: int) -> Column:
    """The matches of one rule as ``(start, rank, kind, end)``, leftmost first."""
    text = F.col("text")
    regex = F.lit(pattern)
    whole = F.regexp_extract_all(text, regex, F.lit(0))
    measured = F.regexp_extract_all(text, regex, F.lit(group))
    gaps = F.split(text, pattern, -1)
    parts = F.zip_with(
        F.zip_with(F.slice(gaps, 1, F.size(whole)), whole,
                   lambda gap, m: F.struct(F.length(gap).cast("bigint").alias("gap"),
                                           F.length(m).cast("bigint").alias("size"))),
        measured, lambda x, m: F.struct(x["gap"].alias("gap"), x["size"].alias("size"),
                                        F.length(m).alias("measured")))
    # running end of the matches so far, and the spans that are long enough
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(_SPAN).alias("found"))

    def step(state: Column, part: Column) -> Column:
        begin = state["at"] + part["gap"]
        end = begin + part["size"]
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"),
                        F.lit(kind).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(
            part["measured"] >= least, F.concat(state["found"], F.array(span)))
            .otherwise(state["found"]).alias("found"))

    found = F.aggregate(parts, start, step, lambda state: state["found"])
    return F.when(F.regexp_like(text, regex), found).otherwise(F.array().cast(_SPAN))


def scan_blobs(blobs: DataFrame, rules: list[tuple[str, str, int, int]]) -> DataFrame:
    """``(blob, spans)`` for ``blobs(blob, text)``."""
    every = [_spans(rank, *rule) for rank, rule in enumerate(rules)]
    return blobs.select("blob", F.sort_array(F.concat(*every)).alias("spans"))


def _blobs(docs: DataFrame, text_col: str) -> DataFrame:
    text = whole_text(text_col)
    return docs.withColumns({"__text": text, "__blob": F.unhex(F.sha2(text.cast("binary"), 256))})


def scan_unseen(docs: DataFrame, ledger: DataFrame | None = None, *, text_col: str = "text",
                rules: list | None = None, version: int = RULES_VERSION) -> DataFrame:
    """The new rows of the ledger: ``(blob, version, spans)`` for blobs of ``docs``
    that ``ledger`` does not hold for ``version``."""
    blobs = (_blobs(docs, text_col).select(F.col("__blob").alias("blob"),
                                           F.col("__text").alias("text")))
    if ledger is not None:
        done = ledger.where(F.col("version") == version).select("blob").distinct()
        blobs = blobs.join(done, "blob", "left_anti")
    # all texts of a blob are the same, so any is the first; copies meet before the shuffle
    once = blobs.groupBy("blob").agg(F.first("text").alias("text"))
    found = scan_blobs(once, rules or BASE_RULES + MORE_RULES)
    return found.select("blob", F.lit(version).alias("version"), "spans")


def secret_scan(docs: DataFrame, ledger: DataFrame | None = None, *, id_col: str = "doc_id",
                text_col: str = "text", rules: list | None = None,
                version: int = RULES_VERSION) -> tuple[DataFrame, DataFrame]:
    """``(findings, additions)``.

    ``findings`` has ``(doc_id, blob, spans)`` for each input row; ``additions``
    are the rows to append to the ledger.  Spans are ordered by start, then in
    the order of the rules; start and end count code points, end exclusive.
    NULL texts are the empty blob and have no findings.  Repeated rows and ids
    each get the findings of their own text; other columns are not read; an
    empty table gives empty results.
    """
    additions = saved(scan_unseen(docs, ledger, text_col=text_col, rules=rules, version=version),
                      "ledger")
    known = additions if ledger is None else additions.unionByName(
        ledger.where(F.col("version") == version).dropDuplicates(["blob"]))
    rows = _blobs(docs, text_col).select(F.col(id_col).alias("doc_id"),
                                         F.col("__blob").alias("blob"))
    return rows.join(known.select("blob", "spans"), "blob").select("doc_id", "blob", "spans"), \
        additions


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows that earlier runs stored at ``path``; None before the first one."""
    try:
        return spark.read.schema(_LEDGER).parquet(path).select("blob", "version", "spans")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def stored_scan(docs: DataFrame, path: str, **options) -> DataFrame:
    """The findings of ``secret_scan`` with the ledger kept at ``path``: blobs that it
    holds for this version of the rules are not scanned, the others are added to it."""
    findings, additions = secret_scan(docs, read_ledger(docs.sparkSession, path), **options)
    # a folder of its own: appends to one folder would share their temporary files
    additions.write.parquet(f"{path.rstrip('/')}/run={uuid.uuid4().hex}")
    return findings


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
