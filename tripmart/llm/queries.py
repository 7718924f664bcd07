"""Registered queries of the text operators, over the whole tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import (
    bpe,
    conversation_sql,
    conversations,
    decontaminate,
    exact,
    language,
    pages,
    private,
    pseudolm,
    resample,
    simhash,
    suffixes,
    toxicity,
    whitening,
)
from tripmart.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/labels.parquet")


def benchmark(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/benchmark.parquet")


def tokenizer_path() -> str:
    """The tokenizer's file; TRIPMART_TOKENIZER names another than the installed one."""
    named = os.environ.get("TRIPMART_TOKENIZER")
    if named:
        return named
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encoded(documents(spark, folder), tokenizer_path())


def op2_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return pseudolm.document_scores(documents(spark, folder))


def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.without_repeats(documents(spark, folder))


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(documents(spark, folder), benchmark(spark, folder))


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    return resample.resampled(documents(spark, folder), labels(spark, folder))


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return language.languages(docs, language.fitted(docs)).drop("spans")


#: Of the registered query alone; a deployment passes its own.
PSEUDONYM_KEY = "tripmart"


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    return private.pseudonymised(documents(spark, folder), PSEUDONYM_KEY)


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = exact.exact_groups(documents(spark, folder))
    return groups.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op9_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_components(documents(spark, folder))
    return found.select(
        "doc_id",
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return toxicity.toxicity_scores(docs, toxicity.fitted(docs, labels(spark, folder)))


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repaired(spark.read.parquet(f"{folder}/conversations.parquet"))


def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(spark.read.parquet(f"{folder}/embeddings.parquet"))


def op13_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return pages.main_text(spark.read.parquet(f"{folder}/pages.parquet"))


QUERIES: dict[str, Query] = {
    "op1_bpe": op1_bpe,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_decontamination": op4_decontamination,
    "op5_quality": op5_quality,
    "op6_language_id": op6_language_id,
    "op7_pii": op7_pii,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_simhash_dedup": op9_simhash_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_html_extraction": op13_html_extraction,
    "pipeline": pipeline,
}

ORACLE_SQL: dict[str, str] = {
    "op8_exact_dedup": """
        WITH digests AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256,
                row_number() OVER () AS row
            FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
            row_number() OVER (PARTITION BY text_sha256
                ORDER BY doc_id DESC NULLS LAST, row DESC) = 1 AS kept, text_sha256
        FROM digests WINDOW same AS (PARTITION BY text_sha256)
    """,
    "op11_conversation_repair": conversation_sql.statement(),
}
