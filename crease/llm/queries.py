"""The registered queries: one per operator, over whole tables, with the digest
columns that make results of any size comparable."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crease.llm import (
    bpe,
    byte_bpe,
    contamination,
    cover_tree,
    fm_index,
    language,
    lines,
    minhash,
    quality,
    r_index,
    secrets,
    token_files,
    vector_codes,
)
from crease.llm._common import table, work_path

TOKENIZER = "word_bpe_49k.json"
RANKS = "byte_bpe_multi_50k.tiktoken"


def _sha(column: Column) -> Column:
    return F.sha2(column.cast("binary"), 256)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.verdict(contamination.benchmark_matches(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
    # items without an id count as one, as in the SQL
    nameless = F.exists("matches", lambda m: m["item"].isNull()).cast("bigint")
    return found.select(
        "row.doc_id", "n_words", "n_hit", (F.size("items") + nameless).alias("n_items"),
        _sha(F.array_join("items", ",")).alias("items_sha256"), "contaminated")


def token_digests(docs: DataFrame) -> DataFrame:
    coded = bpe.bpe_encode(docs.select("doc_id", "text"), public_tokenizers.path(TOKENIZER))
    ids = F.transform("token_ids", lambda i: i.cast("string"))
    return coded.select(
        "row.doc_id", F.size("token_ids").cast("bigint").alias("n_tokens"),
        _sha(F.array_join(ids, " ")).alias("ids_sha256"),
        _sha(F.col("decoded")).alias("decoded_sha256"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).drop("node")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.line_dedup(table(spark, sf_dir, "documents"))
    return out.select("row.doc_id", "n_lines", "n_removed",
                      _sha(F.col("kept_text")).alias("kept_sha256"))


def _n_removed() -> Column:
    return F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fm_index.substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", _n_removed().alias("n_removed"),
                      _sha(F.col("kept_text")).alias("kept_sha256"))


def op6_byte_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = r_index.byte_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", _n_removed().alias("n_removed"),
                      F.size("spans").cast("bigint").alias("n_spans"),
                      _sha(F.col("kept")).alias("kept_sha256"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = language.identify(docs, language.train(docs))
    return out.select("row.doc_id", language.held_out("row.doc_id").alias("held_out"),
                      "lang_pred", "score")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "tokens")
    token_files.write_token_files(table(spark, sf_dir, "documents"),
                                  public_tokenizers.path(TOKENIZER), path)
    return token_files.read_token_files(spark, path)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # a ledger of its own, so that each call scans every text: an earlier state of the
    # table is scanned first, then the whole table finds what the ledger lacks
    ledger = work_path(spark, "secret-ledger")
    secrets.stored_scan(docs.where(F.xxhash64("doc_id") < 0), ledger)
    found = secrets.stored_scan(docs, ledger)
    base = F.filter("spans", lambda s: s["rank"] < len(secrets.BASE_RULES))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"), _sha(secrets.span_list(base)).alias("base_sha256"),
        secrets.span_list(F.col("spans")).alias("spans"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings")).select(
        "row.vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return cover_tree.hard_negatives(rows, F.col("id") % 100 == 0)


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = byte_bpe.byte_bpe_encode(table(spark, sf_dir, "documents"),
                                     public_tokenizers.path(RANKS))
    return coded.select(
        "row.doc_id", F.size("token_ids").cast("bigint").alias("n_tokens"),
        F.sha2("ids_bytes", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_decontamination, op2_bpe, op3_minhash, op4_line_dedup, op5_substring_dedup,
        op6_byte_dedup, op7_language_id, op8_token_files, op9_quality_rules, op10_secret_scan, op11_vector_codes,
        op12_hard_negatives, op13_byte_bpe)
}
