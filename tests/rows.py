"""Hand-written input rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TYPICAL = {
    "source_year": 2024,
    "source_month": 1,
    "tpep_pickup_datetime": "2024-01-08 10:00:00",
    "tpep_dropoff_datetime": "2024-01-08 10:30:00",
    "PULocationID": 1,
    "DOLocationID": 2,
    "passenger_count": 1.0,
    "trip_distance": 3.0,
    "fare_amount": 12.0,
    "tip_amount": 1.0,
    "total_amount": 15.0,
    "payment_type": 1.0,
    "congestion_surcharge": 2.5,
    "airport_fee": None,
    "cbd_congestion_fee": None,
}
TYPES = {
    **dict.fromkeys(TYPICAL, "double"),
    "source_year": "int",
    "source_month": "int",
    "tpep_pickup_datetime": "string",
    "tpep_dropoff_datetime": "string",
    "PULocationID": "bigint",
    "DOLocationID": "bigint",
}


def trips(spark: SparkSession, *changes: dict, types: dict | None = None) -> DataFrame:
    """One typical trip per argument, with the given fields changed."""
    kinds = {**TYPES, **(types or {})}
    schema = ", ".join(f"{name} {kinds[name]}" for name in TYPICAL)
    rows = [tuple({**TYPICAL, **change}[name] for name in TYPICAL) for change in changes]
    table = spark.createDataFrame(rows, schema)
    for name in ("tpep_pickup_datetime", "tpep_dropoff_datetime"):
        if types is None or name not in types:
            table = table.withColumn(name, F.col(name).cast("timestamp_ntz"))
    return table


def zones(spark: SparkSession, *rows: tuple) -> DataFrame:
    """(id, borough, zone) rows as a zone dimension."""
    return spark.createDataFrame(
        [(*row, None) for row in rows],
        "PULocationID bigint, pickup_Borough string, pickup_Zone string,"
        " pickup_service_zone string",
    )


def rows_of(table: DataFrame) -> list[dict]:
    return [row.asDict(recursive=True) for row in table.collect()]


def column(table: DataFrame, name: str) -> list:
    return [row[name] for row in table.select(name).collect()]
