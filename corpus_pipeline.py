"""From raw documents to packed training sequences, one stored table per stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again before the next
stage.  All but the last return the columns of ``documents``: rows that a stage rejects are gone, others are
untouched.  An empty table passes through all stages.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from dugout.llm import decontaminate, exact_dedup, language_id, near_dedup, packing
from dugout.session import materialise, tune

TOKENIZER = "word_bpe_49k.json"


def _tuned(stage):
    """Session settings of the operators; whole texts need small batches."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        tune(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
        return stage(spark, docs, sf_dir)

    return run


@_tuned
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or with too low a language score go; without labels, those with letters stay."""
    return language_id.drop_undetermined(docs)


@_tuned
def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the smallest id stays."""
    return exact_dedup.drop_copies(docs)


@_tuned
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the smallest id stays."""
    return near_dedup.drop_near_duplicates(docs)


@_tuned
def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


@_tuned
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents left, in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER)).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_benchmark_leaks),
    ("pack", pack_sequences),
]
# fitted models and tokenizers cannot be said in SQL; tests compare the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
