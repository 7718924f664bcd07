"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import stored


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """Each node's least neighbour or itself."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    return least.select("a", F.least("a", "least").alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    joined = both.join(_least_neighbour(both), "a")
    return joined.filter(F.col("b") > F.col("a")).select(
        F.col("b").alias("a"), F.col("least").alias("b")
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = _least_neighbour(down)
    joined = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select("a", F.col("least").alias("b"))
    return joined.unionByName(own).filter(F.col("a") != F.col("b")).distinct()


def _mark(edges: DataFrame):
    return edges.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """node and root (the least node of its component) of every linked node.

    links: two columns of longs.  Each round's links are written to the shared
    folder.  Links between a node and itself are ignored.
    """
    edges = stored(links.toDF("a", "b").filter("a != b").distinct(), "links")
    before = None
    for _ in range(rounds):
        edges = stored(_small_star(_large_star(edges)), "stars")
        now = _mark(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components still change after {rounds} rounds")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.toDF("node", "root").unionByName(roots.select("node", F.col("node").alias("root")))
