"""Quality by importance resampling: hashed n-gram models and Gumbel top-k.

Two generative models count hashed word and word-pair features: one over all
documents (raw), one over documents labelled as good (target).  A document's log
importance weight is the sum of the log ratios of its features.  Adding Gumbel noise,
keyed by doc_id and seed, and taking the k largest keys samples k documents without
replacement in proportion to their weights.

The target model reads at most ``target_rows`` labelled documents; raw counts, weights
and the k-th key cover all documents.

Defined cases: a null or empty text has no features and weight 0 (in logs); a null
doc_id takes the noise of zero; rows that repeat a doc_id share its noise; of equal
keys the larger doc_id, then an arbitrary row, is taken first; without good labels
every weight is 0 and the sample is uniform; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import stored, text_chunks, texts

TOKEN = re.compile(r"\w+|[^\w\s]+")


@dataclass(frozen=True)
class Settings:
    buckets: int = 10_000
    target_rows: int = 20_000
    smoothing: float = 1.0
    seed: int = 11


class TokenHashes(dict):
    def __missing__(self, token: str) -> int:
        value = self[token] = zlib.crc32(token.encode("utf-8", "surrogatepass"))
        return value

    def features(self, text: str, buckets: int) -> np.ndarray:
        """Buckets of the text's tokens and neighbouring pairs."""
        if len(self) > 300_000:
            self.clear()
        tokens = TOKEN.findall(text.lower())
        own = np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))
        pairs = (own[:-1] * np.uint64(0x9E3779B97F4A7C15) + own[1:]) * np.uint64(0xBF58476D1CE4E5B9)
        hashed = np.concatenate((own * np.uint64(0x94D049BB133111EB), pairs)) >> np.uint64(32)
        return (hashed % np.uint64(buckets)).astype(np.int64)


def _count_batches(settings: Settings):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = TokenHashes()
        totals = np.zeros((2, settings.buckets), np.int64)
        for batch, held in text_chunks(batches):
            good = batch.column(batch.schema.get_field_index("good")).to_pylist()
            for text, is_good in zip(held, good, strict=True):
                found = np.bincount(hashes.features(text, settings.buckets), minlength=settings.buckets)
                totals[0] += found
                if is_good:
                    totals[1] += found
        seen = np.flatnonzero(totals[0])
        yield pa.RecordBatch.from_pydict(
            {"bucket": pa.array(seen), "raw": pa.array(totals[0][seen]), "target": pa.array(totals[1][seen])}
        )

    return count


def good_ids(labels: DataFrame, settings: Settings) -> DataFrame:
    """At most target_rows ids of documents labelled good, least hashes first."""
    good = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")
    ).filter("doc_id IS NOT NULL AND quality = 1")
    ids = good.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id")
    return ids.limit(settings.target_rows).withColumn("good", F.lit(True))


def log_ratios(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> np.ndarray:
    """Per bucket the log of target over raw probability."""
    flagged = texts(docs).join(F.broadcast(good_ids(labels, settings)), "doc_id", "left")
    counts = (
        flagged.mapInArrow(_count_batches(settings), "bucket long, raw long, target long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .collect()
    )
    totals = np.full((2, settings.buckets), settings.smoothing)
    for row in counts:
        totals[:, row.bucket] += (row.raw, row.target)
    if not any(row.target for row in counts):
        return np.zeros(settings.buckets)
    raw, target = np.log(totals / totals.sum(axis=1, keepdims=True))
    return target - raw


def _weigh_batches(ratios: np.ndarray):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = TokenHashes()
        for batch, held in text_chunks(batches):
            weights = [float(ratios[hashes.features(text, len(ratios))].sum()) for text in held]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(weights, pa.float64())], names=["doc_id", "log_weight"]
            )

    return weigh


def importance(docs: DataFrame, ratios: np.ndarray, seed: int) -> DataFrame:
    """doc_id, log_weight and key (weight plus Gumbel noise) of every document."""
    weighed = texts(docs).mapInArrow(_weigh_batches(ratios), "doc_id long, log_weight double")
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.coalesce("doc_id", F.lit(0))), 11)
    uniform = (bits.cast("double") + 0.5) / F.lit(float(1 << 53))
    return weighed.withColumn("key", F.col("log_weight") - F.log(-F.log(uniform)))


def _ordered_bits(key: str):
    """A double as a long of the same order, in steps of 2**-20."""
    return F.round(F.col(key) * F.lit(float(1 << 20))).cast("long")


def take_largest(keyed: DataFrame, count: int) -> DataFrame:
    """The table with ``selected``: true for the rows with the ``count`` largest keys.

    The bar is found digit by digit: each round counts the rows of a digit's 4096
    values below the digits found so far, so the driver sees at most 4096 rows.
    Equal keys are ordered by doc_id, then by row.
    """
    offset = F.lit(1 << 59)
    rows = stored(
        keyed.withColumns(
            {"order": _ordered_bits("key") + offset, "row": F.monotonically_increasing_id()}
        ),
        "keys",
    )
    # Digits of the order, then of the id (shifted to be unsigned), then of the row.
    fields = [("order", F.col("order"))]
    fields.append(("id", F.coalesce(F.col("doc_id"), F.lit(-(1 << 62))) + F.lit(1 << 62)))
    fields.append(("row", F.col("row")))
    open_, above, left = F.lit(True), F.lit(False), count
    for _, value in fields:
        low = 0
        for shift in range(60, -1, -12):
            digit = F.shiftrightunsigned(value, shift).bitwiseAND(F.lit(4095))
            held = {
                r["digit"]: r["n"]
                for r in rows.filter(open_).groupBy(digit.alias("digit")).agg(F.count("*").alias("n")).collect()
            }
            bar = None
            for d in sorted(held, reverse=True):
                if held[d] > left:
                    bar = d
                    break
                left -= held[d]
            if bar is None:  # all open rows are taken
                return rows.withColumn("selected", above | open_).drop("order", "row")
            low |= bar << shift
            part = F.shiftrightunsigned(value, shift)
            above = above | (open_ & (part > (low >> shift)))
            open_ = open_ & (part == (low >> shift))
            if left == 0:
                return rows.withColumn("selected", above).drop("order", "row")
    raise AssertionError("rows are told apart by their numbers")


def good_share(labels: DataFrame) -> float:
    """The share of labelled rows that are good; 1 without labels."""
    quality = F.col("quality").cast("int")
    row = labels.agg(F.count(quality), F.sum((quality == 1).cast("int"))).first()
    return row[1] / row[0] if row[0] else 1.0


def resampled(
    docs: DataFrame, labels: DataFrame, count: int | None = None, settings: Settings = Settings()
) -> DataFrame:
    """Every document with log_weight, key and selected; count defaults to the good share."""
    keyed = stored(importance(docs, log_ratios(docs, labels, settings), settings.seed), "weights")
    if count is None:
        count = round(keyed.count() * good_share(labels))
    return take_largest(keyed, count)
