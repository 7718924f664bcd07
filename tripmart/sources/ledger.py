"""The month ledger: which months were read, from which files, under which version.

A ledger is a small table with a row per month.  It is written last, as one file in a
folder of its own version, so it appears at once or not at all; what it does not name does
not exist for readers.  One writer at a time.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.contract import DEFAULT, TripContract
from tripmart.sources.months import MONTH_KEYS

LEDGER_SCHEMA = (
    "version int, source_year int, source_month int, data_version int, files long, bytes long,"
    " fingerprint long, raw_rows long"
)


@dataclass(frozen=True)
class MonthRead:
    """A month that was read; a frame that came without files has none."""

    year: int
    month: int
    files: int = 0
    bytes: int = 0
    fingerprint: int | None = None

    @property
    def period(self) -> tuple[int, int]:
        return self.year, self.month


def month_files(spark: SparkSession, folder: str, contract: TripContract = DEFAULT) -> DataFrame:
    """path, source_year, source_month, length, modified of every file of every month.

    A listing only: Spark lists many folders in a job, and no file is opened.
    """
    names = contract.period_file_name.replace("%d", "*").replace("%02d", "*")
    try:
        listed = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .load(f"{folder.rstrip('/')}/{names}")
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        listed = spark.createDataFrame([], "path string, modificationTime timestamp, length long")
    period = [F.regexp_extract("path", contract.period_pattern, k).try_cast("int") for k in (1, 2)]
    return listed.select(
        "path",
        period[0].alias("source_year"),
        period[1].alias("source_month"),
        "length",
        F.col("modificationTime").alias("modified"),
    ).filter(F.col("source_year").isNotNull() & F.col("source_month").isNotNull())


def months_of(files: DataFrame, contract: TripContract = DEFAULT) -> dict[tuple[int, int], MonthRead]:
    """The months of a file table with a fingerprint of their files and of the contract."""
    # A changed contract changes what is read from the same files.
    seed = int.from_bytes(hashlib.sha256(repr(contract).encode()).digest()[:8], "little", signed=True)
    file = F.xxhash64(F.lit(seed), "path", "length", F.col("modified").cast("long"))
    found = files.groupBy(*MONTH_KEYS).agg(
        F.count("*").alias("files"),
        F.sum("length").alias("bytes"),
        F.bit_xor(file).alias("fingerprint"),
    )
    return {(row[0], row[1]): MonthRead(*row) for row in found.collect()}


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The newest complete ledger; no rows if there is none."""
    try:
        every = spark.read.schema(LEDGER_SCHEMA).parquet(f"{folder}/ledger")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)
    newest = every.agg(F.max("version")).first()[0]
    return every.filter(F.col("version") == F.lit(newest))


def write_ledger(ledger: DataFrame, folder: str, version: int) -> None:
    ledger.coalesce(1).write.parquet(f"{folder}/ledger/version={version}")


def changed_months(
    known: DataFrame, found: dict[tuple[int, int], MonthRead]
) -> list[MonthRead]:
    """Months whose files are new or differ from those that were read."""
    prints = {(row.source_year, row.source_month): row.fingerprint for row in known.collect()}
    return [month for period, month in sorted(found.items()) if prints.get(period) != month.fingerprint]
