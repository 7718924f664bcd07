"""Deterministic top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def top_k(
    table: DataFrame, order: list[Column], k: int, partition: list[str] | None = None
) -> DataFrame:
    """The first ``k`` rows in ``order``, per ``partition`` when given.

    ``order`` must be total for the answer to be unique.  Without a partition
    this plans as TakeOrderedAndProject; with one, as a window whose group
    limit also runs before the shuffle.
    """
    if partition is None:
        return table.orderBy(*order).limit(k)
    rank = F.row_number().over(Window.partitionBy(*partition).orderBy(*order))
    return table.withColumn("rank_in_group", rank).filter(F.col("rank_in_group") <= k).drop(
        "rank_in_group"
    )
