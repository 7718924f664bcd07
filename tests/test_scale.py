from dataclasses import replace

from tests.rows import rows_of, trips, zones
from tripmart.contract import DEFAULT
from tripmart.operators.prepare import prepare
from tripmart.operators.scale import scale_cells, scale_sweep
from tripmart.operators.series import successful_scales
from tripmart.sources.months import month_spine


def month(number, location, **more):
    return {
        "source_month": number,
        "tpep_pickup_datetime": f"2024-{number:02d}-08 10:00:00",
        "tpep_dropoff_datetime": f"2024-{number:02d}-08 10:10:00",
        "PULocationID": location,
        **more,
    }


def test_prefix_scales(spark):
    table = trips(
        spark,
        month(1, 1),
        month(1, 1),
        month(1, 264),
        month(2, 2),
        month(2, 2),
        month(2, 3),
        month(3, 3, DOLocationID=None),
        month(5, 3),
        month(5, 3),
    )
    names = zones(spark, (1, "A", "a"), (2, None, "b"), (3, "B", "c"), (264, "U", None))
    contract = replace(DEFAULT, scales=(1, 2, 3, 5))
    spine = month_spine(spark, (2024, 1), (2024, 5))
    sweep = scale_sweep(scale_cells(prepare(table)), names, spine, contract)
    rows = rows_of(sweep)
    assert [
        (r["months"], r["status"], r["valid_rows"], r["files_read"], r["top_pickup_zone"],
         r["top_pickup_zone_trips"])
        for r in rows
    ] == [
        (1, "SUCCESS", 3, 1, "a", 2),
        # Equal trips: the zone without a borough ranks last.
        (2, "SUCCESS", 6, 2, "a", 2),
        # A month of invalid rows is read, it just adds nothing.
        (3, "SUCCESS", 6, 3, "a", 2),
        (5, "SKIPPED", None, None, None, None),
    ]
    assert rows[1]["period"] == "first 2 month(s) from 2024-01"
    assert rows[1]["last_file"] == "yellow_tripdata_2024-02.parquet"
    assert rows[3]["period"] == "2024-01 to 2024-05"
    assert rows[3]["result_or_error"] == "Missing file: yellow_tripdata_2024-04.parquet"
    assert [r["months"] for r in rows_of(successful_scales(sweep))] == [1, 2, 3]


def test_no_named_zone_leaves_a_blank_top(spark):
    contract = replace(DEFAULT, scales=(1,))
    cells = scale_cells(prepare(trips(spark, month(1, 9))))
    spine = month_spine(spark, (2024, 1), (2024, 1))
    row = rows_of(scale_sweep(cells, zones(spark, (1, "A", "a")), spine, contract))[0]
    assert (row["valid_rows"], row["top_pickup_zone"]) == (1, None)
