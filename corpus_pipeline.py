"""From raw documents to token ids: five stages, each over all that its predecessor kept.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``; all but the last return the columns
of ``documents``. The result of a stage is written and read again before the next.

A null or empty text has no language and goes in the first stage. Of repeated rows one is
left, also where doc_id is null; later stages see rows in the order of (doc_id, text).
Further columns, whatever their names, pass through the first four stages. Empty tables
stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from termlode.llm import bpe, decontaminate, exact_dedup, language, near_dedup
from termlode.llm.common import stored


# Rows that a Python worker gets at a time. Executors hold what all stages before left in
# their workers, so batches are small, and so are the blocks of the last stage.
BATCH_ROWS = "1000"
BPE_BLOCK_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that could be told; the rest goes."""
    small_batches(spark)
    return language.drop_undetermined(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the largest id, of each group of equal texts."""
    return exact_dedup.drop_exact_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates."""
    small_batches(spark)
    return near_dedup.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a test item."""
    small_batches(spark)
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with their digest and that of the decoded bytes."""
    small_batches(spark)
    return bpe.round_trip(docs, block_bytes=BPE_BLOCK_BYTES)


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", exact_duplicates),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("byte-level BPE", byte_bpe),
]

# Language ID, sketches and BPE have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each stored for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, "stage")
    return docs
