"""The full report job.

Trips are scanned three times, each scan reading only its columns, to write
three rollups; every table of the report is then merged from those.  A run writes the
months it read under a version of its own and then one ledger, which names each month's
version.  Until the ledger is there, readers see the state before; a rerun of some months
replaces only theirs, and months whose files have not changed are not read again.
Tables are merged from the requested months alone, whatever else is stored.  A missing
month fails the job, or with ``--allow-missing`` leaves out its rows and the scales that
need it; a file without rows gives a month of zeros.

    spark-submit -m tripmart.plans.report --trips DIR --zones CSV --output DIR \\
        --first 2024-01 --last 2025-12 [--slice 2024-01] [--allow-missing]
"""

from __future__ import annotations

import argparse
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.contract import DEFAULT, TripContract
from tripmart.operators import (
    daytype,
    demand,
    fares,
    monthly,
    passengers,
    quality,
    rollup,
    scale,
    series,
)
from tripmart.operators.cells import trip_cells
from tripmart.operators.prepare import in_period, prepare
from tripmart.operators.zones import top_zones, zone_demand
from tripmart.sources.ledger import (
    LEDGER_SCHEMA,
    MonthRead,
    changed_months,
    month_files,
    months_of,
    read_ledger,
    write_ledger,
)
from tripmart.sources.months import MONTH_KEYS, month_spine
from tripmart.sources.tables import read_table, write_table
from tripmart.sources.trips import ContractError, monthly_paths, read_months
from tripmart.sources.zones import assert_unique_key, read_zones

_JOBS_AT_ONCE = 4

MONTH_SCHEMA = "source_year int, source_month int"
#: rollup -> columns its files are partitioned by
ROLLUPS = {"trip": ["grain", *MONTH_KEYS], "location": MONTH_KEYS, "fare": MONTH_KEYS}


def write_rollups(
    trips: DataFrame | list[DataFrame],
    path: str,
    contract: TripContract = DEFAULT,
    read: list[MonthRead] | None = None,
) -> None:
    """Write the rollups of all months in ``trips``, replacing those months only.

    ``read`` names the months that were read, with or without rows; without it they are
    those that have rows.

    Given month by month, each month is aggregated next to its scan and only
    rollup rows meet in the union; otherwise every trip would pass through it.
    Parts of one month may come separately: their cells add up when read.

    ``rebalance`` gathers each month into few files and lets AQE split a month
    whose rollup is large.  The ledger comes last: if a write fails, the new version is
    in no ledger, and the next run writes over it.
    """
    parts = [trips] if isinstance(trips, DataFrame) else trips
    spark = parts[0].sparkSession
    prepared = [prepare(part, contract) for part in parts]
    cells = [trip_cells(part) for part in prepared]
    rollups = {
        "trip": _union([rollup.trip_rollup(part) for part in cells]),
        "location": _union([rollup.location_rollup(part, contract) for part in prepared]),
        "fare": _union([rollup.fare_rollup(part) for part in cells]),
    }
    if read:
        months = spark.createDataFrame([month.period for month in read], MONTH_SCHEMA)
        rollups = {
            name: table.unionByName(_empty_months(table, months))
            for name, table in rollups.items()
        }
    known = read_ledger(spark, path)
    version = (known.agg(F.max("version")).first()[0] or 0) + 1
    _run_all(lambda name: _write_rollup(rollups[name], path, name, version), rollups)
    write_ledger(_next_ledger(spark, path, known, version, read), path, version)


def _write_rollup(table: DataFrame, path: str, name: str, version: int) -> None:
    (
        table.hint("rebalance", *ROLLUPS[name])
        .write.mode("overwrite")
        .partitionBy(*ROLLUPS[name])
        .parquet(f"{path}/{name}/version={version}")
    )


def _next_ledger(
    spark: SparkSession, path: str, known: DataFrame, version: int, read: list[MonthRead] | None
) -> DataFrame:
    """The months of this version, and the others as they were."""
    names = "source_year int, source_month int, raw_rows long"
    stored = spark.read.schema(names).parquet(f"{path}/location/version={version}")
    rows = stored.groupBy(*MONTH_KEYS).agg(F.sum("raw_rows").alias("raw_rows"))
    if read is None:
        found = rows.select(
            *MONTH_KEYS,
            F.lit(0).alias("files"),
            F.lit(0).alias("bytes"),
            F.lit(None).alias("fingerprint"),
            "raw_rows",
        )
    else:
        fields = [(*month.period, month.files, month.bytes, month.fingerprint) for month in read]
        schema = f"{MONTH_SCHEMA}, files long, bytes long, fingerprint long"
        found = spark.createDataFrame(fields, schema).join(rows, MONTH_KEYS, "left")
    fresh = found.withColumn("data_version", F.lit(version))
    kept = known.join(fresh, MONTH_KEYS, "left_anti")
    both = kept.drop("version").unionByName(fresh).withColumn("version", F.lit(version))
    return both.to(T.StructType.fromDDL(LEDGER_SCHEMA)).drop("version")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _run_all(job, names) -> None:
    """Run independent jobs side by side, so one job's tail leaves no idle cores."""
    with ThreadPoolExecutor(_JOBS_AT_ONCE) as pool:
        list(pool.map(job, names))


def read_rollups(
    spark: SparkSession, path: str, months: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The rollups that the ledger names, of the expected months only where these are given."""
    ledger = read_ledger(spark, path)
    # One row per month, and one folder per run that some month still comes from.
    versions = [row[0] for row in ledger.select("data_version").distinct().collect()]
    wanted = ledger.select(F.col("data_version").alias("version"), *MONTH_KEYS)
    if months is not None:
        wanted = wanted.join(months.select(*MONTH_KEYS), MONTH_KEYS, "left_semi")

    def one(name: str) -> DataFrame:
        folders = [f"{path}/{name}/version={version}" for version in sorted(versions)]
        stored = spark.read.option("basePath", f"{path}/{name}").parquet(*folders)
        return stored.join(wanted, ["version", *MONTH_KEYS], "left_semi").drop("version")

    rollups = {name: one(name) for name in ROLLUPS}
    rollups["fare"] = rollups["fare"].filter("trips > 0")
    return rollups


def _empty_months(stored: DataFrame, months: DataFrame) -> DataFrame:
    """A row without trips for each month that was read, in the shape of a rollup."""
    grains = [F.lit(grain) for grain in (rollup.DAY_GRAIN, rollup.CATEGORY_GRAIN)]

    def column(name: str, dtype: str) -> Column:
        if name in MONTH_KEYS:
            return F.col(name).cast(dtype)
        if name == "grain":
            return F.explode(F.array(*grains))
        is_sum = dtype in ("bigint", "double") and name not in ("fare_amount", "PULocationID")
        return F.lit(0 if is_sum else None).cast(dtype)

    return months.select(*[column(*field).alias(field[0]) for field in stored.dtypes])


def report_tables(
    rollups: dict[str, DataFrame],
    zones: DataFrame,
    months: DataFrame | None = None,
    contract: TripContract = DEFAULT,
    read: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All report tables from stored rollups.

    ``months`` is the expected spine and enables the scale sweep.  ``read`` are those of its
    months that were read (all of them if not given): they have rows in the monthly tables
    even without any data; a scale with a month that was not read is skipped.
    """
    observed = months if read is None else read
    days, categories = rollup.day_cells(rollups["trip"]), rollup.category_cells(rollups["trip"])
    location = rollups["location"]
    # The fare histogram is additive over months, as the other rollups are.
    histogram = fares.merge_histograms(rollups["fare"], ["distance_band"])
    by_month = monthly.monthly_comparison(days, observed)
    by_quality = quality.monthly_quality(location, zones, observed)
    grains = daytype.daytype_grains_from_rollups(days, location)
    tables = {
        "common_metrics": demand.common_metrics_of_tables(
            by_quality, demand.hourly_counts(days), zone_demand(location, zones)
        ),
        "monthly_quality": by_quality,
        "monthly_trip_demand": monthly.monthly_demand(by_month),
        "hourly_demand": demand.hourly_demand(days),
        "top_pickup_zones": top_zones(location, zones, contract.top_zone_rows),
        "distance_fare_summary": fares.distance_fare_summary(categories, histogram, contract),
        "passenger_count_summary": passengers.passenger_summary(categories, contract),
        "passenger_single_multiple_summary": passengers.single_vs_multiple(categories, contract),
        "weekday_weekend_summary": daytype.weekday_weekend_summary(grains, zones, contract),
        "weekday_weekend_hourly": daytype.weekday_weekend_hourly(days, contract),
        "monthly_year_comparison": by_month,
        "year_comparison_summary": monthly.year_summary(by_month),
        "monthly_avg_daily": monthly.with_daily_average(by_month),
    }
    if months is not None:
        tables["scale_sweep"] = scale.scale_sweep(location, zones, months, contract)
    return tables


def series_tables(
    tables: dict[str, DataFrame],
    contract: TripContract = DEFAULT,
    years: list[int] | None = None,
) -> dict[str, DataFrame]:
    """The report's series, shaped for plotting, from its finished tables.

    With the ledger's ``years`` no job runs to find the columns of the series by year.
    """
    daily = tables["monthly_avg_daily"]
    found = {
        "series_band_fares": series.band_fares(tables["distance_fare_summary"], contract),
        "series_passengers": series.passenger_distribution(
            tables["passenger_count_summary"], contract
        ),
        "series_daytype_hourly": series.daytype_hourly(tables["weekday_weekend_hourly"], contract),
        "series_month_volume": series.month_by_year(daily, "trip_count", years),
        "series_month_avg_daily": series.month_by_year(daily, "avg_daily_trips", years),
        "series_month_fare": series.month_by_year(daily, "avg_valid_fare_amount", years),
        "series_cbd_share": series.cbd_share(tables["monthly_year_comparison"]),
    }
    if "scale_sweep" in tables:
        found["series_scale"] = series.successful_scales(tables["scale_sweep"])
    return found


def slice_tables(
    rollups: dict[str, DataFrame],
    zones: DataFrame,
    year: int,
    month: int,
    contract: TripContract = DEFAULT,
) -> dict[str, DataFrame]:
    """The tables of one period, the input of a reconciliation."""
    trip = in_period(rollups["trip"], year, month)
    days, categories = rollup.day_cells(trip), rollup.category_cells(trip)
    location = in_period(rollups["location"], year, month)
    by_quality = quality.monthly_quality(location, zones)
    common = demand.common_metrics_of_tables(
        by_quality, demand.hourly_counts(days), zone_demand(location, zones)
    )
    return {
        "common_metrics": common.drop("months_processed"),
        "hourly_demand": demand.hourly_demand(days),
        "top_pickup_zones": top_zones(location, zones, contract.top_zone_rows),
        "distance_fare_summary": fares.period_distance_summary(categories, contract),
        "quality_summary": by_quality,
    }


def write_tables(tables: dict[str, DataFrame], path: str, fmt: str = "csv") -> None:
    _run_all(lambda name: write_table(tables[name], f"{path}/{name}", fmt), tables)


def build_report(
    spark: SparkSession,
    trips: DataFrame | list[DataFrame],
    zones: DataFrame,
    output: str,
    months: DataFrame | None = None,
    slice_period: tuple[int, int] | None = None,
    contract: TripContract = DEFAULT,
    fmt: str = "csv",
    read: list[MonthRead] | None = None,
) -> None:
    """Rollups, all report tables and, when asked for, one period's slice.

    ``read``: the months that ``trips`` were read from; see ``write_rollups``.
    """
    assert_unique_key(zones)
    # No trips: nothing has changed, and the stored months are reported again.
    if isinstance(trips, DataFrame) or trips:
        write_rollups(trips, f"{output}/rollups", contract, read)
    ledger = read_ledger(spark, f"{output}/rollups").select(*MONTH_KEYS)
    if months is not None:
        ledger = months.join(ledger, MONTH_KEYS, "left_semi")
    rollups = read_rollups(spark, f"{output}/rollups", months)
    tables = report_tables(rollups, zones, months, contract, ledger)
    write_tables(tables, f"{output}/tables", fmt)
    # The series are read from the stored tables, not merged from the rollups again.
    kept = {
        name: read_table(spark, f"{output}/tables/{name}", table.schema, fmt)
        for name, table in tables.items()
    }
    years = sorted(row[0] for row in ledger.select("source_year").distinct().collect())
    write_tables(series_tables(kept, contract, years), f"{output}/series", fmt)
    if slice_period is not None:
        year, month = slice_period
        tables = slice_tables(rollups, zones, year, month, contract)
        write_tables(tables, f"{output}/slice-{year}-{month:02d}", fmt)


def update_report(
    spark: SparkSession,
    folder: str,
    zones: DataFrame,
    output: str,
    first: tuple[int, int],
    last: tuple[int, int],
    slice_period: tuple[int, int] | None = None,
    contract: TripContract = DEFAULT,
    fmt: str = "csv",
    allow_missing: bool = False,
) -> list[tuple[int, int]]:
    """The report of a folder of monthly files; gives the months that were read for it.

    Months whose files are those of the ledger are merged from their rollups.  A month that
    the folder no longer has is missing, also if an earlier run read it.
    """
    wanted = periods_between(first, last)
    found = months_of(month_files(spark, folder, contract), contract)
    absent = [period for period in wanted if period not in found]
    if absent and not allow_missing:
        raise ContractError(f"expected file is missing: {monthly_paths(folder, absent, contract)[0]}")
    present = {period: found[period] for period in wanted if period in found}
    if not present:
        raise ContractError(f"no monthly file of the range in {folder}")
    known = read_ledger(spark, f"{output}/rollups")
    changed = changed_months(known, present)
    paths = monthly_paths(folder, [month.period for month in changed], contract)
    spine = month_spine(spark, first, last)
    if absent:
        gone = spark.createDataFrame(absent, MONTH_SCHEMA)
        forget_months(spark, f"{output}/rollups", gone)
    frames = read_months(spark, paths, contract) if paths else []
    build_report(spark, frames, zones, output, spine, slice_period, contract, fmt, changed)
    return [month.period for month in changed]


def forget_months(spark: SparkSession, path: str, months: DataFrame) -> None:
    """A ledger without the given months, if it has any of them."""
    known = read_ledger(spark, path)
    left = known.join(months, MONTH_KEYS, "left_anti")
    if left.count() < known.count():
        version = known.agg(F.max("version")).first()[0] + 1
        write_ledger(left.drop("version"), path, version)


def _period(text: str) -> tuple[int, int]:
    year, month = text.split("-")
    return int(year), int(month)


def periods_between(first: tuple[int, int], last: tuple[int, int]) -> list[tuple[int, int]]:
    count = (last[0] - first[0]) * 12 + last[1] - first[1] + 1
    start = first[0] * 12 + first[1] - 1
    return [((start + i) // 12, (start + i) % 12 + 1) for i in range(count)]


def main() -> None:
    parser = argparse.ArgumentParser(description="Trip report from monthly Parquet files")
    parser.add_argument("--trips", required=True, help="folder of monthly files")
    parser.add_argument("--zones", required=True, help="zone dimension CSV")
    parser.add_argument("--output", required=True, help="folder on shared storage")
    parser.add_argument("--first", required=True, type=_period, help="first month, YYYY-MM")
    parser.add_argument("--last", required=True, type=_period, help="last month, YYYY-MM")
    parser.add_argument("--slice", type=_period, help="also write this period's tables")
    parser.add_argument("--allow-missing", action="store_true", help="report what is there")
    given = parser.parse_args()
    spark = SparkSession.builder.appName("tripmart report").getOrCreate()
    update_report(
        spark,
        given.trips,
        read_zones(spark, given.zones),
        given.output,
        given.first,
        given.last,
        given.slice,
        allow_missing=given.allow_missing,
    )


if __name__ == "__main__":
    main()
