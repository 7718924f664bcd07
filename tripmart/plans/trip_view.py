"""Trips and zones derived from an order-line star schema.

Lets every operator run on generic order tables: a shipped order line plays a
trip, its customer's nation the pickup zone, its ship month the source period.
The modulo rules below plant missing values, bad durations and unknown
locations; they shape the data and select nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.sources.zones import zone_dimension


#: Columns read here; a given schema spares reading footers to infer one.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")


def order_line_trips(
    spark: SparkSession,
    folder: str,
    spans: list[tuple[str, str]] | None = None,
    located: bool = True,
) -> DataFrame:
    """Trip rows with source_year / source_month.

    ``spans`` of dates, their ends excluded, limit the ship dates, the way a caller of
    monthly files passes only the months it needs; they reach the Parquet scan.  ``located`` false leaves the pickup location null and spares
    the joins that find it.
    """
    lines = _table(spark, folder, "lineitem")
    if spans is not None:
        shipped = F.col("l_shipdate")
        within = [
            (shipped >= F.lit(first).cast("timestamp_ntz"))
            & (shipped < F.lit(end).cast("timestamp_ntz"))
            for first, end in spans
        ]
        lines = lines.filter(reduce(Column.__or__, within))
    if not located:
        return _trips(lines.withColumn("c_nationkey", F.lit(None).cast("int")))
    # Orders meet their customers first: then the lines, the largest table, are
    # joined (and where nothing fits a broadcast, shuffled) once, not twice.
    orders = _table(spark, folder, "orders")
    customers = _table(spark, folder, "customer")
    buyers = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
    joined = lines.join(
        buyers.select("o_orderkey", "c_nationkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left"
    )
    return _trips(joined)


def _trips(joined: DataFrame) -> DataFrame:
    minutes = (
        "(CASE WHEN l_suppkey % 50 = 0 THEN 1440 ELSE 0 END"
        " + (l_orderkey * 37 + l_partkey * 11 + l_linenumber * 101) % 1440)"
    )
    seconds = "((l_partkey * 17 + l_suppkey * 29 + l_linenumber * 7) % 14800 - 200)"
    return joined.selectExpr(
        "cast(year(l_shipdate) AS INT) AS source_year",
        "cast(month(l_shipdate) AS INT) AS source_month",
        # A null offset gives a null time.
        f"timestampadd(MINUTE, CASE WHEN l_partkey % 997 <> 0 THEN cast({minutes} AS INT) END,"
        " l_shipdate) AS tpep_pickup_datetime",
        "timestampadd(SECOND, CASE WHEN l_partkey % 991 <> 0 THEN"
        f" cast({minutes} * 60 + {seconds} AS INT) END, l_shipdate) AS tpep_dropoff_datetime",
        "CASE WHEN l_orderkey % 499 = 0 THEN NULL WHEN l_orderkey % 101 = 0 THEN 99L"
        " ELSE cast(c_nationkey AS BIGINT) END AS PULocationID",
        "CASE WHEN l_orderkey % 503 = 0 THEN NULL ELSE l_suppkey % 25 END AS DOLocationID",
        "CASE WHEN l_partkey % 6 = 0 THEN NULL WHEN l_partkey % 401 = 0 THEN 8D"
        " ELSE cast(l_linenumber - 1 AS DOUBLE) END AS passenger_count",
        "CASE WHEN l_partkey % 307 = 0 THEN NULL ELSE (l_quantity - 1) / 2 END AS trip_distance",
        "CASE WHEN l_partkey % 311 = 0 THEN NULL WHEN l_discount = 0.1D"
        " THEN -l_extendedprice / 1000 ELSE l_extendedprice / 1000 END AS fare_amount",
        "l_tax AS tip_amount",
        "CASE WHEN l_discount = 0.1D THEN -l_extendedprice * (1 + l_tax) / 1000"
        " ELSE l_extendedprice * (1 + l_tax) / 1000 END AS total_amount",
        "cast(l_linenumber % 4 AS DOUBLE) AS payment_type",
        "CASE WHEN l_returnflag = 'R' THEN NULL WHEN l_linestatus = 'O' THEN 2.5D"
        " ELSE 0D END AS congestion_surcharge",
        "cast(NULL AS DOUBLE) AS airport_fee",
        "CASE WHEN year(l_shipdate) < 2000 OR l_returnflag = 'A' THEN NULL"
        " WHEN l_linestatus = 'O' THEN 0.75D ELSE 0D END AS cbd_congestion_fee",
    )


def nation_zones(spark: SparkSession, folder: str) -> DataFrame:
    """Zone dimension from nations and regions; see :func:`zone_rows`."""
    return zone_dimension(zone_rows(spark, folder))


def zone_rows(spark: SparkSession, folder: str, repeats: bool = False) -> DataFrame:
    """Zone rows as a file has them, with the awkward rows planted: one zone without
    a borough, one without a name, two sharing a name.

    With ``repeats`` every third location comes again under other texts, and each row has its
    place in ``row_order``.
    """
    nations = _table(spark, folder, "nation")
    regions = _table(spark, folder, "region")
    zones = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
        "cast(n_nationkey AS BIGINT) AS LocationID",
        "CASE WHEN n_nationkey = 23 THEN NULL ELSE r_name END AS Borough",
        "CASE WHEN n_nationkey = 24 THEN NULL WHEN n_nationkey = 10 THEN 'NATION_5'"
        " ELSE n_name END AS Zone",
        "concat('Zone ', n_regionkey) AS service_zone",
    )
    if not repeats:
        return zones
    copies = F.when(F.col("LocationID") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    return zones.withColumn("copy", F.explode(copies)).select(
        "LocationID",
        *[
            F.when(F.col("copy") == 0, F.col(name)).otherwise(F.lit("repeated")).alias(name)
            for name in ("Borough", "Zone", "service_zone")
        ],
        (F.col("copy") * 1000 + F.col("LocationID")).alias("row_order"),
    )
