"""The pickup-zone dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.contract import DEFAULT, TripContract
from tripmart.functions.clean import as_bigint, text_or_null
from tripmart.sources.trips import ContractError

ZONE_NAMES = {
    "LocationID": "PULocationID",
    "Borough": "pickup_Borough",
    "Zone": "pickup_Zone",
    "service_zone": "pickup_service_zone",
}


def read_zones(spark: SparkSession, path: str, contract: TripContract = DEFAULT) -> DataFrame:
    """Zone CSV -> one row per location; the first row of the file wins."""
    raw = spark.read.option("header", True).csv(path)
    absent = [name for name in contract.zone_columns if name not in raw.columns]
    if absent:
        raise ContractError(f"{path} is missing required columns: {', '.join(absent)}")
    in_file_order = raw.select(
        *contract.zone_columns,
        F.struct(
            F.col("_metadata.file_path"),
            F.col("_metadata.file_block_start"),
            F.monotonically_increasing_id(),
        ).alias("file_order"),
    )
    return zone_dimension(in_file_order, "file_order", contract)


def zone_dimension(
    rows: DataFrame, order: str | None = None, contract: TripContract = DEFAULT
) -> DataFrame:
    """Typed, renamed and de-duplicated zone rows.

    Rows whose key is null or not a number are dropped.  With ``order`` given,
    the first row of each key in that order is kept; the aggregate combines on
    the map side, so repeated keys do not travel.
    """
    key, *texts = contract.zone_columns
    cleaned = rows.select(
        as_bigint(rows, key).alias(ZONE_NAMES[key]),
        *[text_or_null(F.col(name), contract.na_texts).alias(ZONE_NAMES[name]) for name in texts],
        *([order] if order else []),
    ).filter(F.col(ZONE_NAMES[key]).isNotNull())
    if order is None:
        return cleaned
    names = [ZONE_NAMES[name] for name in texts]
    return (
        cleaned.groupBy(ZONE_NAMES[key])
        .agg(F.min_by(F.struct(*names), F.col(order)).alias("first_row"))
        .select(ZONE_NAMES[key], "first_row.*")
    )


def dim_key_violations(zones: DataFrame, key: str = "PULocationID") -> DataFrame:
    """Keys that would break the many-to-one join, with their row counts."""
    return zones.groupBy(key).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


def assert_unique_key(zones: DataFrame, key: str = "PULocationID") -> None:
    broken = dim_key_violations(zones, key).take(1)
    if broken:
        raise ContractError(f"dimension key {key} is not unique: {broken[0][key]}")
