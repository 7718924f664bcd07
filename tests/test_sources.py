import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tests.rows import TYPICAL, column, rows_of, trips, zones
from tripmart.operators.prepare import in_period, prepare
from tripmart.sources import footers
from tripmart.sources.months import missing_months, month_spine, require_months
from tripmart.sources.tables import read_table, write_table
from tripmart.sources.trips import (
    ContractError,
    monthly_paths,
    period_columns,
    period_of,
    read_trips,
    scan_months,
)
from tripmart.sources.zones import assert_unique_key, dim_key_violations, read_zones

START = dt.datetime(2024, 1, 8, 10)


def write_month(folder, month, **changes):
    """A monthly file; a change to None drops the column, a tuple renames it."""
    columns = {
        "tpep_pickup_datetime": pa.array([START], pa.timestamp("us")),
        "tpep_dropoff_datetime": pa.array([START + dt.timedelta(minutes=5)], pa.timestamp("us")),
        "PULocationID": pa.array([7], pa.int64()),
        "DOLocationID": pa.array([8], pa.int64()),
    }
    for name in TYPICAL:
        if name not in columns and not name.startswith("source_"):
            columns[name] = pa.array([TYPICAL[name]], pa.float64())
    for name, change in changes.items():
        if change is None:
            del columns[name]
        elif isinstance(change, tuple):
            columns[change[0]] = columns.pop(name)
        else:
            columns[name] = change
    path = f"{folder}/yellow_tripdata_{month}.parquet"
    pq.write_table(pa.table(columns), path)
    return path


def test_files_of_different_schemas_read_as_one(spark, tmp_path):
    paths = [
        write_month(tmp_path, "2024-01"),
        write_month(
            tmp_path,
            "2024-02",
            airport_fee=("Airport_fee",),
            PULocationID=pa.array([9], pa.int32()),
            passenger_count=pa.array([2], pa.int64()),
            cbd_congestion_fee=None,
        ),
        write_month(
            tmp_path,
            "2024-03",
            PULocationID=pa.array(["11"], pa.string()),
            fare_amount=pa.array(["x"], pa.string()),
            tpep_pickup_datetime=pa.array(["2024-03-01 10:00:00"], pa.string()),
        ),
    ]
    table = read_trips(spark, paths).orderBy("source_month")
    assert dict(table.dtypes)["PULocationID"] == "bigint"
    assert dict(table.dtypes)["tpep_pickup_datetime"] == "timestamp_ntz"
    assert column(table, "source_month") == [1, 2, 3]
    assert column(table, "PULocationID") == [7, 9, 11]
    assert column(table, "fare_amount") == [12.0, 12.0, None]
    assert column(table, "cbd_congestion_fee") == [None, None, None]
    assert column(table, "tpep_pickup_datetime")[2] == dt.datetime(2024, 3, 1, 10)


def test_period_filter_drops_other_months_scans(spark, tmp_path):
    paths = [write_month(tmp_path, f"2024-0{month}") for month in (1, 2, 3)]
    one = in_period(prepare(read_trips(spark, paths)), 2024, 2)
    plan = one._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1
    assert one.count() == 1


def test_a_month_may_be_a_directory(spark, tmp_path):
    path = f"{tmp_path}/yellow_tripdata_2024-01.parquet"
    trips(spark, {}, {}).drop("source_year", "source_month").write.parquet(path)
    assert column(read_trips(spark, [path]), "source_year") == [2024, 2024]


def test_missing_required_column_in_a_file(spark, tmp_path):
    path = write_month(tmp_path, "2024-01", total_amount=None)
    with pytest.raises(ContractError, match="total_amount"):
        read_trips(spark, [path])


def test_period_from_file_name(spark):
    assert period_of("/x/yellow_tripdata_2025-12.parquet") == (2025, 12)
    with pytest.raises(ContractError):
        period_of("/x/yellow_tripdata_2025-1.parquet")
    names = spark.createDataFrame([("yellow_tripdata_2024-03.parquet",)], "name string")
    year, month = period_columns(F.col("name"))
    assert names.select(year, month).collect() == [(2024, 3)]
    bad = spark.createDataFrame([("trips.parquet",)], "name string")
    with pytest.raises(Exception, match="no period"):
        bad.select(*period_columns(F.col("name"))).collect()


def test_period_from_scanned_file(spark, tmp_path):
    path = write_month(tmp_path, "2024-07")
    year, month = period_columns(F.col("_metadata.file_name"))
    assert spark.read.parquet(path).select(year, month).collect() == [(2024, 7)]


def test_month_spine_and_missing_months(spark):
    spine = month_spine(spark, (2024, 11), (2025, 2))
    assert column(spine, "month") == ["2024-11", "2024-12", "2025-01", "2025-02"]
    assert column(spine, "month_index") == [1, 2, 3, 4]
    seen = trips(
        spark,
        *[{"source_year": y, "source_month": m} for y, m in ((2024, 11), (2025, 1), (2025, 2))],
    )
    assert column(missing_months(spine, seen), "month") == ["2024-12"]
    with pytest.raises(ContractError, match="2024-12"):
        require_months(spine, seen)
    require_months(month_spine(spark, (2025, 1), (2025, 2)), seen)
    assert monthly_paths("/data/", [(2024, 1)]) == ["/data/yellow_tripdata_2024-01.parquet"]


def test_zone_file(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text(
        "LocationID,Borough,Zone,service_zone\n"
        '1,"EWR","Newark Airport","EWR"\n'
        '264,"Unknown","N/A","N/A"\n'
        '265,"N/A","Outside of NYC","N/A"\n'
        '1,"Other","Later row","X"\n'
        'x,"No","Number",""\n'
        ',"No","Key",""\n'
    )
    table = {row["PULocationID"]: row for row in rows_of(read_zones(spark, str(path)))}
    assert set(table) == {1, 264, 265}
    assert table[1]["pickup_Zone"] == "Newark Airport"
    assert table[264]["pickup_Zone"] is None and table[264]["pickup_Borough"] == "Unknown"
    assert table[265]["pickup_Borough"] is None
    assert table[265]["pickup_service_zone"] is None


def test_zone_file_needs_its_columns(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text("LocationID,Zone\n1,A\n")
    with pytest.raises(ContractError, match="Borough"):
        read_zones(spark, str(path))


def test_dimension_key_must_be_unique(spark):
    good, bad = zones(spark, (1, "A", "a")), zones(spark, (1, "A", "a"), (1, "B", "b"))
    assert_unique_key(good)
    assert dim_key_violations(bad).collect() == [(1, 2)]
    with pytest.raises(ContractError, match="not unique: 1"):
        assert_unique_key(bad)


def test_tables_round_trip(spark, tmp_path):
    path = f"{tmp_path}/deep/table"
    table = spark.createDataFrame([("0-<2", 3, 1.5), ("2-<5", 0, None)], "b string, n int, x double")
    write_table(table, path)
    write_table(table, path)
    assert sorted(read_table(spark, path, "b string, n int, x double").collect()) == sorted(
        table.collect()
    )
    assert read_table(spark, path).columns == ["b", "n", "x"]
    with pytest.raises(AnalysisException):
        read_table(spark, f"{tmp_path}/absent")


def test_one_scan_for_all_months(spark, tmp_path):
    months = [f"20{20 + k // 12}-{k % 12 + 1:02d}" for k in range(24)]
    paths = [write_month(tmp_path, month) for month in months]
    table = scan_months(spark, paths)
    assert table.dtypes == read_trips(spark, paths).dtypes
    assert sorted(table.collect()) == sorted(read_trips(spark, paths).collect())
    plan = lambda n: scan_months(spark, paths[:n])._jdf.queryExecution().optimizedPlan().toString()
    assert plan(24).count("Relation") == plan(2).count("Relation") == 2
    assert len(plan(24).splitlines()) == len(plan(2).splitlines())


def test_one_scan_converts_and_checks_as_the_others_do(spark, tmp_path):
    folder = tmp_path / "a b%20c"
    folder.mkdir()
    paths = [
        write_month(folder, "2024-01"),
        write_month(folder, "2024-02", PULocationID=pa.array(["11"], pa.string())),
    ]
    assert sorted(scan_months(spark, paths).collect()) == sorted(read_trips(spark, paths).collect())
    with pytest.raises(ContractError, match="fare_amount"):
        scan_months(spark, [*paths, write_month(folder, "2024-03", fare_amount=None)])


def test_every_file_of_a_month_is_checked_in_one_job(spark, tmp_path):
    month = tmp_path / "yellow_tripdata_2024-01.parquet"
    month.mkdir()
    source = write_month(tmp_path, "2024-05")
    for k in range(300):
        os.link(source, month / f"part-{k:05d}.parquet")
    spark.sparkContext.setJobGroup("footers", "footers of a month")
    assert read_trips(spark, [str(month)]).count() == 300
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("footers")
    spark.sparkContext._jsc.clearJobGroup()
    assert len(jobs) <= 6
    odd = write_month(tmp_path, "2024-06", PULocationID=pa.array(["11"], pa.string()))
    os.link(odd, month / "part-00999.parquet")
    assert sorted(set(column(read_trips(spark, [str(month)]), "PULocationID"))) == [7, 11]
    os.link(write_month(tmp_path, "2024-07", tip_amount=None), month / "part-01000.parquet")
    with pytest.raises(ContractError, match="part-01000.*tip_amount"):
        read_trips(spark, [str(month)])


def test_files_that_tasks_cannot_open_are_read_by_spark(spark, tmp_path, monkeypatch):
    path = write_month(tmp_path, "2024-01", fare_amount=pa.array(["3.5"], pa.string()))
    monkeypatch.setattr(footers, "_footer_rows", lambda wanted: unread_footers)
    assert column(read_trips(spark, [path]), "fare_amount") == [3.5]


def unread_footers(batches):
    for batch in batches:
        nothing = pa.nulls(batch.num_rows, pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), nothing], names=["path", "schema"])
