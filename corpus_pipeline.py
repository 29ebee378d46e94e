"""The corpus pipeline: five stages over ``documents``, each on all that the one
before it kept.  All but the last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crease.llm import contamination, language, lines, minhash
from crease.llm._common import saved, table
from crease.llm.queries import token_digests

#: a prediction below this is no better than a guess between two languages
MIN_SCORE = 0.35


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter and texts whose language cannot be told."""
    judged = language.identify(docs, language.train(docs))
    return judged.where((F.col("lang_pred") != language.UNDETERMINED)
                        & (F.col("score") >= MIN_SCORE)).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out repeated lines; a document with no words left goes."""
    out = lines.line_dedup(docs)
    out = out.where((F.col("n_removed") == 0) | F.col("kept_text").rlike(r"[^\x20\x09-\x0D]"))
    changed = F.col("n_removed") > 0
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("bigint")}
    return out.select(*[
        F.when(changed, new[c]).otherwise(F.col(f"row.`{c}`")).alias(c) if c in new
        else F.col(f"row.`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return minhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return contamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text."""
    return token_digests(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("bpe_tokens", bpe_tokens),
]

#: a trained model decides the first stage: not expressible in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
