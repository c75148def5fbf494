"""The registered queries of the training-data operators, and their SQL where there is any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termlode.llm import (
    alignment,
    bpe,
    decontaminate,
    exact_dedup,
    html_text,
    language,
    language_model,
    licenses,
    line_templates,
    near_dedup,
    substrings,
    token_counts,
    whitening,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents")).drop("rid")


def op2_minhash_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents")).drop("rid")


def op3_token_counts(spark, sf_dir):
    counts = token_counts.document_token_counts(table(spark, sf_dir, "documents"))
    return counts.select("doc_id", "n_tokens")


def op4_language_id(spark, sf_dir):
    return language.language_predictions(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark, sf_dir):
    cleaned = line_templates.drop_recurring(table(spark, sf_dir, "documents"))
    return cleaned.select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op6_byte_bpe(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark, sf_dir):
    cleaned = substrings.drop_repeats(table(spark, sf_dir, "documents"))
    return cleaned.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op8_html_extraction(spark, sf_dir):
    texts = html_text.main_text(table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


def op9_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents")).drop("rid")


def op10_decontamination(spark, sf_dir):
    return decontaminate.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op11_tokenizer_alignment(spark, sf_dir):
    return alignment.align(table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_lm_scoring(spark, sf_dir):
    return language_model.learn_and_score(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_minhash_near_dedup": op2_minhash_near_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_language_id": op4_language_id,
    "op5_line_dedup": op5_line_dedup,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_html_extraction": op8_html_extraction,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_tokenizer_alignment": op11_tokenizer_alignment,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_lm_scoring": op13_lm_scoring,
}

ORACLES = {
    "op1_license_scan": licenses.sql(),
    "op5_line_dedup": line_templates.SQL,
    "op9_exact_dedup": """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents""",
}
