"""A training corpus from raw documents, in five stages.

Each stage takes (spark, documents, folder of tables) and gives the documents that it
keeps, with their columns; the last gives token counts and digests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.llm import bpe, decontaminate, exact, simhash, toxicity
from tripmart.llm.common import documents, stored
from tripmart.llm.queries import benchmark, labels, tokenizer_path

#: Model scores and Hamming links are not SQL expressions.
ORACLE_SQL = None
#: Near copies share this much of their shingles of so many words (Jaccard).
COPY_WORDS, COPY_SIMILARITY = 5, 0.8


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the toxicity cut; the model learns from these documents' labels."""
    return toxicity.drop_toxic(docs, toxicity.fitted(docs, labels(spark, sf_dir)))


def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest doc_id."""
    return exact.drop_copies(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least doc_id."""
    return simhash.drop_near_copies(docs, width=COPY_WORDS, similarity=COPY_SIMILARITY)


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, benchmark(spark, sf_dir))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text."""
    return bpe.encoded(docs, tokenizer_path())


STAGES = [
    ("toxicity", remove_toxic),
    ("exact dedup", remove_copies),
    ("simhash near-dedup", remove_near_copies),
    ("benchmark decontamination", remove_leaks),
    ("bpe", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
