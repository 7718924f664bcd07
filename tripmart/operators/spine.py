"""Fixed category domains: every label appears, in order, even when empty."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def domain(table: DataFrame, column: str, labels) -> DataFrame:
    """The labels as a one-partition frame with their position ``ord``."""
    spark = table.sparkSession
    names = F.array(*[F.lit(label) for label in labels])
    return spark.range(0, len(labels), 1, 1).select(
        F.col("id").cast("int").alias("ord"),
        F.get(names, F.col("id").cast("int")).alias(column),
    )


def with_domain(table: DataFrame, column: str, labels, counts: list[str]) -> DataFrame:
    """Left-join a table keyed by a label column onto its full domain.

    ``table`` holds at most one row per label, so the broadcast side is bounded
    by the length of the domain itself.
    """
    filled = domain(table, column, labels).join(F.broadcast(table), column, "left")
    return filled.withColumns({name: F.coalesce(name, F.lit(0)) for name in counts})
