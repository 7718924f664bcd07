"""Helpers of the text operators: shared folder, stored tables, text batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters of text that a task holds as Python words at once.
CHUNK_CHARS = 2_000_000


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is the session's ``spark.checkpoint.dir``.  Only a session whose driver is
    its one executor may go without; it then gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tripmart-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(table: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read back: a cut in the lineage."""
    spark = table.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    table.write.parquet(path)
    return spark.read.schema(table.schema).parquet(path)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text alone; a null text is empty."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def fresh(table: DataFrame, name: str) -> str:
    """The name, lengthened until no column of the table has it."""
    taken = {column.lower() for column in table.columns}
    while name in taken:
        name += "_"
    return name


def fold(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id's text modulo parts; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id) % parts


def text_chunks(
    batches: Iterator[pa.RecordBatch], limit: int = CHUNK_CHARS
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches with at most ``limit`` characters (or one row), and their texts."""
    for batch in batches:
        start, held, size = 0, [], 0
        column = batch.column(batch.schema.get_field_index("text"))
        for row, value in enumerate(column):
            text = value.as_py() or ""
            if held and size + len(text) > limit:
                yield batch.slice(start, row - start), held
                start, held, size = row, [], 0
            held.append(text)
            size += len(text)
        if held:
            yield batch.slice(start), held
