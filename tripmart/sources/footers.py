"""Footers of trip files, read in tasks.

A file table is a row per file, from a listing alone.  Its rows read their footers where
Spark deals them, and what comes to the driver is a row per month and schema, however many
files a month has.  A file that a task cannot open (a store that only Spark's readers know)
is read by Spark, file by file.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyarrow import fs
from pyarrow import parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from tripmart.contract import DEFAULT, TripContract

_DRIVER_READERS = 8
_TASKS_PER_CORE = 4


def file_table(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path (as a scan's ``_metadata.file_path`` spells it) and plain_path of every file."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    return listed.select(F.col("_metadata.file_path").alias("path"), F.col("path").alias("plain_path"))


def _spark_schema(file: pq.ParquetFile, wanted: set[str]) -> T.StructType:
    """The wanted top-level columns as Spark reads them; INT96 is an instant."""
    leaves = file.metadata.schema
    instants = {
        leaves.column(k).path for k in range(len(leaves)) if leaves.column(k).physical_type == "INT96"
    }
    return T.StructType(
        [
            T.StructField(
                field.name,
                T.TimestampType()
                if field.name in instants
                else from_arrow_type(field.type, prefer_timestamp_ntz=True),
            )
            for field in file.schema_arrow
            if field.name.lower() in wanted
        ]
    )


def _footer_rows(wanted: set[str]):
    def read(path: str) -> str | None:
        try:
            if path.startswith("file:"):
                place, inner = fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
            else:
                place, inner = fs.FileSystem.from_uri(path)
            with place.open_input_file(inner) as opened:
                return _spark_schema(pq.ParquetFile(opened), wanted).json()
        except Exception:  # whatever a store's library raises: Spark reads this file instead
            return None

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schemas = [read(path) for path in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(schemas, pa.string())], names=["path", "schema"]
            )

    return rows


def footers(files: DataFrame, contract: TripContract = DEFAULT) -> DataFrame:
    """path and schema (its contract columns, as JSON; null if no task could read it)."""
    wanted = {name.lower() for name in contract.columns}
    tasks = files.sparkSession.sparkContext.defaultParallelism * _TASKS_PER_CORE
    return files.coalesce(tasks).mapInArrow(_footer_rows(wanted), "path string, schema string")


def month_schemas(
    spark: SparkSession,
    paths: list[str],
    period: tuple[Column, Column],
    contract: TripContract = DEFAULT,
) -> dict[tuple[int, int], list[tuple[T.StructType, list[str] | None, str]]]:
    """Per month its schemas, each with its files (None: all of the month's) and one of them.

    ``period`` gives year and month of a ``path``, parsed once a file.  One job for all
    months; files are listed by name only for months of several schemas.
    """
    year, month = period
    read = footers(file_table(spark, paths), contract).select(
        "path", "schema", year.alias("source_year"), month.alias("source_month")
    )
    grouped = read.groupBy("source_year", "source_month", "schema").agg(F.min("path").alias("one"))
    found = [(row.source_year, row.source_month, row.schema, row.one) for row in grouped.collect()]
    months: dict[tuple[int, int], list] = {}
    several = len({row[:2] for row in found}) < len(found) or any(row[2] is None for row in found)
    if not several:
        for y, m, schema, one in found:
            months.setdefault((y, m), []).append((_struct(schema), None, one))
        return months
    mixed = {row[:2] for row in found if sum(row[:2] == other[:2] for other in found) > 1}
    mixed |= {row[:2] for row in found if row[2] is None}
    for y, m, schema, one in found:
        if (y, m) not in mixed:
            months.setdefault((y, m), []).append((_struct(schema), None, one))
    wanted = spark.createDataFrame(sorted(mixed), "source_year int, source_month int")
    rows = read.join(F.broadcast(wanted), ["source_year", "source_month"]).collect()
    unread = [row.path for row in rows if row.schema is None]
    with ThreadPoolExecutor(_DRIVER_READERS) as pool:
        known = dict(
            zip(unread, pool.map(lambda path: spark.read.parquet(path).schema.json(), unread), strict=True)
        )
    by_schema: dict[tuple, list[str]] = {}
    for row in rows:
        key = (row.source_year, row.source_month, row.schema or known[row.path])
        by_schema.setdefault(key, []).append(row.path)
    for (y, m, schema), files in sorted(by_schema.items()):
        months.setdefault((y, m), []).append((_struct(schema), sorted(files), min(files)))
    return months


def _struct(schema: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(schema))
