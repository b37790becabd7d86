"""Corpus pipeline over the documents table: each stage reads what the one
before it kept, as Parquet, and its decisions take effect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import chosen_path, decontaminate, line_dedup, nbest, quality_rules
from strata.llm.common import table, written
from strata.llm.queries import tokenizer


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned decision list rejects go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines similar to an earlier line go; n_chars follows the text."""
    out = line_dedup.dedup_lines(docs)
    if "n_chars" not in docs.columns:
        return out
    kind = docs.schema["n_chars"].dataType
    return out.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies stays."""
    return chosen_path.keep_first(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as piece ids, with the N best segmentations."""
    return nbest.segmentations(docs, tokenizer("piece_bpe_32k.model")).withColumnRenamed(
        "id", "doc_id")


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard_join", ngram_join_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("sentencepiece_nbest", pieces_stage),
]

# Learned rules, a randomised join and a piece lattice have no SQL form; the
# stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
