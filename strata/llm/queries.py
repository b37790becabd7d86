"""The training-data queries: name -> function(spark, sf_dir), and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    chosen_path,
    conversation_repair,
    decontaminate,
    embedding_dedup,
    html_extract,
    importance_resampling,
    line_dedup,
    nbest,
    quality_rules,
    repair,
    secrets_scan,
    sql,
    surrogates,
    token_counts,
)
from strata.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def tokenizer(name: str) -> str:
    """Place of a public vocabulary file; another path may be given instead."""
    import public_tokenizers
    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    def wrap(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return wrap


# Whoever runs the query for publication chooses a secret key instead.
SURROGATE_KEY = "strata-query-key"


@query("op1_pii_surrogates")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace_entities(docs, SURROGATE_KEY, counts=True)


@query("op6_quality_rules")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_line_dedup")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, counts=("n_lines", "n_removed"))


@query("op4_ngram_jaccard_join")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_duplicates(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "class_id", "n_links", F.col("sig").alias("set_id"),
        F.col("size").alias("n_shingles"), F.col("first").alias("kept"))


@query("op5_benchmark_decontamination")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"),
                                      table(spark, sf_dir, "benchmark"))


@query("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(
        table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model")).select(
        F.col("id").alias("doc_id"), "n_tokens")


@query("op9_sentencepiece_nbest")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbest.segmentations(
        table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model")).withColumnRenamed(
        "id", "doc_id")


@query("op2_secret_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A source stands for an owner, a source's language for one of its repositories.
    return secrets_scan.scan(
        table(spark, sf_dir, "documents"), F.col("source"),
        F.concat_ws("/", "source", "lang")).withColumnRenamed("id", "doc_id")


@query("op8_repair_output")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = repair.write_shards(table(spark, sf_dir, "documents"),
                                 tokenizer("word_bpe_49k.json"), end_id=2)
    return repair.read_documents(shards).withColumnRenamed("id", "doc_id")


@query("op7_html_extraction")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"))


@query("op11_conversation_repair", sql.CONVERSATION_REPAIR)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = table(spark, sf_dir, "conversations")
    return conversation_repair.reports(conversation_repair.damaged(convs), convs)


@query("op12_embedding_near_dedup", sql.NEAR_VECTORS)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op13_importance_resampling", sql.RESAMPLING)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampling.resampled(table(spark, sf_dir, "documents"),
                                           table(spark, sf_dir, "benchmark"))
