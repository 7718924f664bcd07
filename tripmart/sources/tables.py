"""Result tables: written with a header, read back under a schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_table(table: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write a result table, replacing what is there (parents are created)."""
    writer = table.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    fmt: str = "csv",
    infer: bool = True,
) -> DataFrame:
    """Read a result table.  A missing path raises Spark's AnalysisException.

    Without a schema the CSV reader infers types, which suits the small tables
    this library writes; pass one for anything large.  Without ``infer`` CSV columns
    stay text: inference reads a month such as 2024-01 as a date.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
        if schema is None and infer:
            reader = reader.option("inferSchema", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)
