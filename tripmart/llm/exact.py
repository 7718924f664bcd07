"""Exact duplicates with a heavy-hitter split.

Misra-Gries summaries of each partition name the few digests that may hold many
rows.  Their exact winners are aggregated before any shuffle of rows, broadcast
(at most ``counters + 1`` rows) and resolve those rows where they lie; only the
other digests are shuffled.  No shuffled group then holds more than
``2 / counters`` of the rows.

Defined cases: a null text counts as empty, and empty texts equal each other; a
null doc_id is smaller than any other (``keep_id`` is null if a group has no
other); of rows that repeat both doc_id and text exactly one stays; an empty
table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.common import fresh, stored

COUNTERS = 1024
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def normalised_digest(text: str):
    """SHA-256 of the text with A-Z lower-cased; null counts as empty."""
    lower = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, UPPER.lower())
    return F.unhex(F.sha2(lower.cast("binary"), 256))


def digest_rows(docs: DataFrame) -> DataFrame:
    """One stored row per document: doc_id, digest and a number that tells rows apart."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        normalised_digest("text").alias("digest"),
        F.monotonically_increasing_id().alias("row"),
    )
    return stored(rows, "digests")


def _shrink(counts: dict[bytes, int], counters: int) -> dict[bytes, int]:
    if len(counts) <= counters:
        return counts
    cut = sorted(counts.values(), reverse=True)[counters]
    return {key: n - cut for key, n in counts.items() if n > cut}


def _summaries(counters: int):
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        for batch in batches:
            for pair in batch.column(0).value_counts().to_pylist():
                held[pair["values"]] = held.get(pair["values"], 0) + pair["counts"]
            held = _shrink(held, counters)
        yield pa.RecordBatch.from_pydict(
            {
                "digest": pa.array(list(held), pa.binary()),
                "n": pa.array(list(held.values()), pa.int64()),
            }
        )

    return summarise


def heavy_winners(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Exact size and winner of each digest that may be frequent: counters + 1 rows at most.

    Summed counters miss at most rows / (counters + 1) occurrences, so every digest
    with twice that many rows reaches the bar, and no more than counters + 1 can.
    """
    bar = rows.count() / (counters + 1)
    summed = (
        rows.select("digest")
        .mapInArrow(_summaries(counters), "digest binary, n long")
        .groupBy("digest")
        .agg(F.sum("n").alias("n"))
    )
    named = stored(summed.filter(F.col("n") >= bar).select("digest"), "heavy")
    return (
        rows.join(F.broadcast(named), "digest")
        .groupBy("digest")
        .agg(
            F.max(F.struct("doc_id", "row")).alias("winner"),
            F.count("*").alias("group_size"),
        )
    )


def exact_groups(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Per row: doc_id, digest, keep_id, group_size, kept (one row of each group)."""
    rows = digest_rows(docs)
    winners = stored(heavy_winners(rows, counters), "winners")
    split = rows.join(F.broadcast(winners), "digest", "left")
    group = Window.partitionBy("digest")
    rare = (
        split.filter(F.col("winner").isNull())
        .withColumn("winner", F.max(F.struct("doc_id", "row")).over(group))
        .withColumn("group_size", F.count("*").over(group))
    )
    return (
        split.filter(F.col("winner").isNotNull())
        .unionByName(rare)
        .select(
            "doc_id",
            "digest",
            F.col("winner.doc_id").alias("keep_id"),
            "group_size",
            (F.col("row") == F.col("winner.row")).alias("kept"),
        )
    )


def drop_copies(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The documents, one of each group of equal texts, with all their columns.

    Rows are found again by doc_id and digest; repeats of both are cut to one.
    """
    groups = stored(exact_groups(docs, counters), "groups")
    key, own_kept, rows = (fresh(docs, name) for name in ("own_key", "own_kept", "own_rows"))

    def identity(doc_id: Column, digest: Column) -> Column:
        return F.struct(F.coalesce(doc_id.cast("string"), F.lit("")).alias("id"), digest.alias("digest"))

    per_key = (
        groups.filter(F.col("group_size") > 1)
        .groupBy(identity(F.col("doc_id"), F.col("digest")).alias(key))
        .agg(F.max("kept").alias(own_kept), F.count("*").alias(rows))
    )
    keyed = docs.withColumn(
        key, identity(F.col("doc_id").cast("long"), normalised_digest("text"))
    ).join(per_key, key, "left")
    single = keyed.filter(
        F.coalesce(own_kept, F.lit(True)) & (F.coalesce(rows, F.lit(1)) == 1)
    )
    once = keyed.filter(F.col(own_kept) & (F.col(rows) > 1)).dropDuplicates([key])
    return single.unionByName(once).select(docs.columns)
