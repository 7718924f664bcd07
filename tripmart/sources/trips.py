"""Monthly trip Parquet files under the trip contract."""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.contract import DEFAULT, TripContract
from tripmart.functions.clean import actual_names, as_bigint, as_double, as_wall_clock
from tripmart.sources.footers import file_table, month_schemas

#: Physical types the Parquet reader itself widens to the contract type.
_WIDENS_TO_BIGINT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_WIDENS_TO_DOUBLE = (T.ByteType, T.ShortType, T.IntegerType, T.FloatType, T.DoubleType)


#: Files whose periods may be broadcast, some 200 bytes each.
_BROADCAST_FILES = 100_000


class ContractError(ValueError):
    """Input does not satisfy the trip contract."""


def check_columns(columns, contract: TripContract = DEFAULT, source: str = "input") -> None:
    """Raise when a required column is absent (names match in any case)."""
    present = actual_names(columns)
    absent = [name for name in contract.required if name.lower() not in present]
    if absent:
        raise ContractError(f"{source} is missing required columns: {', '.join(absent)}")


def period_of(path: str, contract: TripContract = DEFAULT) -> tuple[int, int]:
    """(year, month) spelled in a monthly file or directory name."""
    found = re.search(contract.period_pattern, path)
    if found is None:
        raise ContractError(f"no period in monthly file name: {path}")
    return int(found.group(1)), int(found.group(2))


def period_columns(path: Column, contract: TripContract = DEFAULT) -> tuple[Column, Column]:
    """The same as columns, for any frame that carries a path or file name.

    A name without a period fails the query instead of yielding null.  Matching
    a pattern per row is slow; the readers apply it once a file.
    """

    def part(group: int) -> Column:
        number = F.regexp_extract(path, contract.period_pattern, group).try_cast("int")
        failure = F.raise_error(F.concat(F.lit("no period in monthly file name: "), path))
        return F.coalesce(number, failure.cast("int"))

    return part(1), part(2)


def typed_trips(trips: DataFrame, contract: TripContract = DEFAULT) -> DataFrame:
    """Contract columns under their canonical names and types.

    Optional columns the input lacks become null.  Columns that already have
    the contract type pass through untouched, so filters on them still reach
    the scan.
    """
    check_columns(trips.columns, contract)
    present = actual_names(trips.columns)

    def pick(name: str, convert) -> Column:
        actual = present.get(name.lower())
        value = F.lit(None).cast("double") if actual is None else convert(trips, actual)
        return value.alias(name)

    return trips.select(
        "source_year",
        "source_month",
        *[pick(name, as_wall_clock) for name in contract.timestamps],
        *[pick(name, as_bigint) for name in contract.ids],
        *[pick(name, as_double) for name in contract.measures + contract.optional_measures],
    )


def contract_schema(contract: TripContract = DEFAULT) -> T.StructType:
    """Read schema: the widest type each column may need."""
    fields = [T.StructField(name, T.TimestampNTZType()) for name in contract.timestamps]
    fields += [T.StructField(name, T.LongType()) for name in contract.ids]
    fields += [
        T.StructField(name, T.DoubleType())
        for name in contract.measures + contract.optional_measures
    ]
    return T.StructType(fields)


def _reader_widens(schema: T.StructType, contract: TripContract) -> bool:
    allowed = {name.lower(): (T.TimestampNTZType,) for name in contract.timestamps}
    allowed |= {name.lower(): _WIDENS_TO_BIGINT for name in contract.ids}
    allowed |= {
        name.lower(): _WIDENS_TO_DOUBLE
        for name in contract.measures + contract.optional_measures
    }
    return all(
        isinstance(field.dataType, allowed.get(field.name.lower(), T.DataType)) for field in schema
    )


def _scans(
    spark: SparkSession, paths: list[str], contract: TripContract
) -> list[tuple[tuple[int, int], T.StructType, list[str]]]:
    """What to read: (month, schema, paths), after a look at the footers of all files.

    Files that lack a required column are an error, not a column of nulls.  Files whose
    physical types the Parquet reader can widen are read under the contract schema (so a
    column may be spelled in any case, and an optional one may be absent).
    """
    of_month: dict[tuple[int, int], list[str]] = {}
    for path in paths:
        of_month.setdefault(period_of(path, contract), []).append(path)
    found = month_schemas(spark, paths, period_columns(F.col("path"), contract), contract)
    scans = []
    for period, given in of_month.items():
        read_as: dict[str, tuple[T.StructType, list[str] | None]] = {}
        for schema, files, one in found.get(period, []):
            check_columns(schema.names, contract, unquote(one))
            if _reader_widens(schema, contract):
                schema = contract_schema(contract)
            key = schema.json()
            held = read_as.get(key, (schema, []))[1]
            read_as[key] = (schema, None if files is None else [*(held or []), *files])
        if len(read_as) == 1:
            read_as = {key: (schema, None) for key, (schema, _) in read_as.items()}
        # A month without files, a directory that holds none, has no rows.
        for schema, files in read_as.values() or [(contract_schema(contract), None)]:
            scans.append((period, schema, given if files is None else [unquote(f) for f in files]))
    return scans


def read_months(
    spark: SparkSession, paths: list[str], contract: TripContract = DEFAULT
) -> list[DataFrame]:
    """Monthly files as lazy frames labelled with the period in their names.

    Each month is its own scan with its period as two constants.  The validity
    rule then folds to comparisons with constants, and a filter on the period
    removes the other months' scans from the plan; deriving the period from the
    file path of every row costs several times the rest of the scan.

    Only footers are read here, in one job for all files of all months.  Files whose types
    the Parquet reader cannot widen are read as they are and converted column by column.
    """
    scans = []
    for period, schema, files in _scans(spark, paths, contract):
        year, month = (F.lit(number) for number in period)
        scan = spark.read.schema(schema).parquet(*files)
        labelled = scan.withColumns({"source_year": year, "source_month": month})
        scans.append(typed_trips(labelled, contract))
    return scans


def scan_months(
    spark: SparkSession, paths: list[str], contract: TripContract = DEFAULT
) -> DataFrame:
    """All months in one scan for each way their files are read: the plan does not grow with them.

    For reports over all of many months; ``read_trips`` prunes better by period.  The period
    is parsed once a file and joined by the path that a scan tells of its rows.  Spark
    broadcasts that table of files while it is small.
    """
    year, month = period_columns(F.col("path"), contract)
    periods = file_table(spark, paths).select(
        F.col("path").alias("own_path"), year.alias("source_year"), month.alias("source_month")
    )
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for _, schema, files in _scans(spark, paths, contract):
        groups.setdefault(schema.json(), (schema, []))[1].extend(files)
    scans = []
    for schema, files in groups.values():
        scan = spark.read.schema(schema).parquet(*files)
        named = scan.select("*", F.col("_metadata.file_path").alias("own_path"))
        scans.append(typed_trips(named.join(_sized(periods), "own_path"), contract))
    return reduce(DataFrame.unionByName, scans)


def _sized(periods: DataFrame) -> DataFrame:
    """The table of files, marked for broadcast if it has few rows."""
    small = periods.limit(_BROADCAST_FILES + 1).count() <= _BROADCAST_FILES
    return F.broadcast(periods) if small else periods


def read_trips(
    spark: SparkSession, paths: list[str], contract: TripContract = DEFAULT
) -> DataFrame:
    """All monthly files as one frame; see ``read_months``."""
    return reduce(DataFrame.unionByName, read_months(spark, paths, contract))


def monthly_paths(
    folder: str, periods: list[tuple[int, int]], contract: TripContract = DEFAULT
) -> list[str]:
    """Expected monthly paths in the given (chronological) order."""
    return [f"{folder.rstrip('/')}/{contract.period_file_name % period}" for period in periods]
