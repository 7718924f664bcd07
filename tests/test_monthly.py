"""Month and year tables, with published yearly figures as fixed values."""

import pytest

from tests.rows import column, rows_of, trips
from tripmart.operators import monthly, passengers, series
from tripmart.operators.cells import trip_cells
from tripmart.operators.prepare import prepare
from tripmart.operators.ranking import top_k
from tripmart.operators.demand import busiest_hour, hour_order
from tripmart.sources.months import month_spine

# One published year by month
# (month, trips, mean fare, mean total, mean surcharge).
YEAR = [
    (1, 2961858, 18.644830195533057, 27.44454341876005, 2.2563756086964073),
    (2, 3004906, 18.543706300974165, 27.29837363801709, 2.2667132611160747),
    (3, 3579447, 19.26519055775627, 27.896832847557505, 2.2526411663624044),
    (4, 3511098, 19.570847766190045, 28.28983575915013, 2.2454544868551243),
    (5, 3720547, 20.360833199382864, 29.201900218913377, 2.2424598225109738),
    (6, 3535959, 20.080074269741342, 28.803091425435408, 2.239161547930219),
    (7, 3073895, 20.31094321451132, 29.113337778874747, 2.1964594493931817),
    (8, 2976214, 20.555025730899136, 29.372838506767938, 2.174690417201297),
    (9, 3630055, 20.797277454086743, 29.577306503306968, 2.2202446558990103),
    (10, 3830854, 20.498627185383587, 29.46034632896042, 2.230992168590745),
    (11, 3642502, 19.970871577713574, 28.675584335508248, 2.2374108663859174),
    (12, 3665110, 20.549427738756737, 29.496721905534507, 2.221731395055613),
]
YEAR_FARE, YEAR_TOTAL, YEAR_SURCHARGE = 19.96154876936021, 28.753200435569383, 2.232427812718964
# Trips of one published month by hour, and of all months by passenger count.
HOURS = [78975, 53560, 37462, 24769, 16709, 18749, 41391, 83648, 117126, 128857, 138657, 150411,
         164432, 169714, 182697, 189177, 190015, 206065, 212616, 183870, 159877, 160762,
         143144, 109175]
# (category, trips, mean duration)
CATEGORIES = [
    ("1", 57570888, 16.43471663432856),
    ("2", 10457033, 18.172986279505217),
    ("3", 2469035, 18.00953827440006),
    ("4", 1634036, 18.74782835261892),
    ("5", 491024, 15.457938783711862),
    ("6", 314330, 15.561909246121377),
]

MONTHLY = (
    "pickup_year int, pickup_month int, trip_count bigint, avg_valid_fare_amount double,"
    " avg_total_amount_for_valid_fare double, avg_congestion_surcharge double,"
    " cbd_fee_charged_trips bigint"
)


def table_of(spark, rows):
    return spark.createDataFrame([(2024, *row, 0) for row in rows], MONTHLY)


def test_published_year(spark):
    row = rows_of(monthly.year_summary(table_of(spark, YEAR)))[0]
    assert row["total_valid_trips"] == 41132445
    assert row["avg_daily_trips"] == pytest.approx(112383.72950819672)
    assert (row["peak_month"], row["peak_monthly_trips"]) == (10, 3830854)
    assert row["avg_monthly_valid_fare_amount"] == pytest.approx(YEAR_FARE, rel=1e-14)
    assert row["avg_monthly_total_amount"] == pytest.approx(YEAR_TOTAL, rel=1e-14)
    assert row["avg_congestion_surcharge"] == pytest.approx(YEAR_SURCHARGE, rel=1e-14)
    daily = rows_of(monthly.with_daily_average(table_of(spark, YEAR)))
    assert [r["days_in_month"] for r in daily[:3]] == [31, 29, 31]
    assert daily[1]["avg_daily_trips"] == pytest.approx(103617.44827586207)


def test_published_hours(spark):
    table = spark.createDataFrame(list(enumerate(HOURS)), "pickup_hour int, trip_count bigint")
    assert [tuple(r) for r in busiest_hour(table).collect()] == [(18, 212616)]
    assert column(top_k(table, hour_order(), 2), "pickup_hour") == [18, 17]
    assert sum(HOURS) == YEAR[0][1]


def test_published_passenger_groups(spark):
    cells = spark.createDataFrame(
        [(name, n, mean * n, n) for name, n, mean in CATEGORIES],
        "passenger_category string, trip_count bigint, duration_sum double, duration_count bigint",
    )
    for state in ("fare", "distance"):
        cells = cells.selectExpr("*", f"0D AS {state}_sum", f"0L AS {state}_count")
    single, many = rows_of(passengers.single_vs_multiple(cells))
    assert single["share_of_valid_1_to_6_pct"] == pytest.approx(78.93305760066455)
    assert many["trip_count"] == 15365458
    assert many["avg_trip_duration_min"] == pytest.approx(18.067676074695157, rel=1e-12)


def test_year_means_propagate_null_but_surcharge_reads_zero(spark):
    rows = [(1, 10, None, 5.0, 2.0), (2, 10, 4.0, 5.0, None)]
    row = rows_of(monthly.year_summary(table_of(spark, rows)))[0]
    assert row["avg_monthly_valid_fare_amount"] is None
    assert row["avg_monthly_total_amount"] == 5.0
    assert row["avg_congestion_surcharge"] == 1.0


def test_peak_month_tie_takes_the_earlier(spark):
    rows = [(3, 7, 1.0, 1.0, 1.0), (2, 7, 1.0, 1.0, 1.0)]
    assert column(monthly.year_summary(table_of(spark, rows)), "peak_month") == [2]


def test_cbd_share(spark):
    fee = "cbd_congestion_fee"
    table = trips(
        spark,
        {},
        *[
            {
                "source_month": 2,
                "tpep_pickup_datetime": "2024-02-08 10:00:00",
                "tpep_dropoff_datetime": "2024-02-08 10:10:00",
                fee: value,
            }
            for value in (None, 0.0, 0.75, 0.75)
        ],
        {"source_month": 3},
    )
    result = monthly.monthly_comparison(
        trip_cells(prepare(table)), month_spine(spark, (2024, 1), (2024, 4))
    )
    rows = rows_of(monthly.monthly_cbd_fee(result))
    assert [(r["cbd_fee_available"], r["cbd_fee_charged_trips"], r["cbd_fee_charged_share_pct"])
            for r in rows] == [(False, 0, None), (True, 2, 50.0), (False, 0, None), (False, 0, None)]
    # An all-invalid month and a month without rows keep their rows.
    assert column(monthly.monthly_demand(result), "trip_count") == [1, 4, 0, 0]
    assert column(series.cbd_share(result), "pickup_month") == [2]
    wide = rows_of(series.month_by_year(result, "trip_count", [2024, 2025]))
    assert wide[0] == {"pickup_month": 1, "2024": 1, "2025": None}
