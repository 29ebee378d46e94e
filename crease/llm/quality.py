"""Quality rules judged per host.

Each document is measured by base rules.  A host (the ``source`` column) is
judged by the share of its documents that fail: the share is shrunk towards
the corpus by a beta prior fitted to all hosts by moments, so a host with few
documents is not condemned by them.  A host whose shrunk share reaches
``reject_rate`` loses its other documents too.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crease.llm import _text
from crease.llm._common import map_rows, saved, whole_text

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_WINDOW = 5

_MEASURED = "doc bigint, host string, n_words bigint, word_chars bigint, n_symbols bigint, " \
            "n_dup_lines bigint, n_repeat_words bigint"


def _per_document(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeat_words(words: _text.Words) -> np.ndarray:
    """Per document the words in windows that are found twice or more in it."""
    out = np.zeros(len(words.first) - 1, np.int64)
    n = len(words.hash)
    if n < _WINDOW:
        return out
    grams = _text.Rolling(words.hash).every(_WINDOW)
    for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:], strict=True)):
        if b - a <= _WINDOW:
            continue
        here = grams[a:b - _WINDOW + 1]
        order = np.argsort(here, kind="stable")
        same = here[order[1:]] == here[order[:-1]]
        if same.any():
            step = np.zeros(b - a + 1, np.int64)
            again = np.zeros(len(here), bool)
            again[order[1:][same]] = True
            again[order[:-1][same]] = True
            step[:len(here)] += again
            step[_WINDOW:_WINDOW + len(here)] -= again
            out[i] = np.count_nonzero(np.cumsum(step[:-1]))
    return out


def _dup_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    if b"\n" not in text:
        return 0
    lines = [x for x in text.split(b"\n") if x.split(None, 1)]
    return len(lines) - len(set(lines))


def measure(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc"),
                       F.col(host_col).cast("string").alias("host"),
                       whole_text(text_col).alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = _text.utf8(batch.column("text"))
        found: list[list[np.ndarray]] = []
        for a, b in _text.groups(offsets):
            part, off = data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
            words = _text.Words(part, off)
            first_byte = (part & 0xC0) != 0x80  # one per character
            found.append([
                words.counts(),
                _per_document(first_byte & _text.NOT_SPACE[part], off),
                _per_document(_SYMBOL[part], off),
                np.array([_dup_lines(t) for t in _text.strings(part, off)], np.int64),
                _repeat_words(words)])
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found \
            else [np.zeros(0, np.int64)] * 5
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        return pa.record_batch({"doc": batch.column("doc"), "host": batch.column("host")}
                               | dict(zip(names, columns, strict=True)))

    return map_rows(rows, run, _MEASURED)


def host_verdicts(measured: DataFrame, reject_rate: float) -> DataFrame:
    """``(host, docs, fails, rate, rejected)`` of each host.

    The prior is the beta distribution with the mean and variance of the
    hosts' shares, weighted by documents; with no variance between hosts
    beyond chance the shares shrink to the mean.
    """
    hosts = measured.where("host IS NOT NULL").groupBy("host").agg(
        F.count(F.lit(1)).alias("docs"), F.sum(F.col("base_failed").cast("bigint")).alias("fails"))
    hosts = saved(hosts, "hosts")
    share = F.col("fails") / F.col("docs")
    moments = hosts.agg(
        (F.sum("fails") / F.sum("docs")).alias("mean"), F.sum("docs").alias("n"),
        F.sum(F.col("docs") * share * share).alias("square"),
        F.count(F.lit(1)).alias("hosts"))
    # one row of numbers, whatever the number of hosts
    row = moments.first()
    if not row.n:
        return hosts.select("host", "docs", "fails", share.alias("rate"),
                            F.lit(False).alias("rejected"))
    mean = row.mean
    # the spread of the shares without what chance adds
    chance = mean * (1 - mean) * row.hosts / row.n
    spread = max(row.square / row.n - mean * mean - chance, 1e-9)
    strength = min(max(mean * (1 - mean) / spread - 1, 1.0), 1e6)
    rate = (F.col("fails") + mean * strength) / (F.col("docs") + strength)
    return hosts.select("host", "docs", "fails", rate.alias("rate"),
                        (rate >= reject_rate).alias("rejected"))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  host_col: str = "source", *, min_words: int = 10, max_repeat_percent: int = 20,
                  reject_rate: float = 0.5) -> DataFrame:
    """One row per input row: the id, the measures, ``base_failed``, the host's
    shrunk ``host_rate`` and ``kept``.

    A document is kept unless it fails a base rule (fewer than ``min_words``
    words, or more than ``max_repeat_percent`` of them in repeated five-word
    windows) or its host is rejected.  A NULL text has no words and fails.  A
    document without a host is judged by the base rules alone (its
    ``host_rate`` is NULL).  Repeated rows count and are judged one by one; an
    empty table gives an empty result.  Other columns are not read.
    """
    failed = (F.col("n_words") < min_words) | \
        (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    measured = saved(measure(docs, id_col, text_col, host_col)
                     .withColumn("base_failed", failed), "measured")
    verdicts = saved(host_verdicts(measured, reject_rate).select("host", "rate", "rejected"),
                     "verdicts")
    out = measured.join(verdicts, "host", "left")
    return out.select(
        F.col("doc").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", F.col("rate").alias("host_rate"),
        (~F.col("base_failed") & ~F.coalesce("rejected", F.lit(False))).alias("kept"))
