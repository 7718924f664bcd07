"""Independent SQL statements of every registered query (checked in DuckDB).

Each statement spells the rule out again over the raw tables, without using the
library, so that a wrong reading in one place shows up as a difference.
"""

from __future__ import annotations

TRIPS = """
trips AS (
  SELECT source_year, source_month,
    CASE WHEN l_partkey % 997 = 0 THEN NULL ELSE p0 END AS tpep_pickup_datetime,
    CASE WHEN l_partkey % 991 = 0 THEN NULL ELSE p0 + to_seconds(
      (l_partkey * 17 + l_suppkey * 29 + l_linenumber * 7) % 14800 - 200) END
      AS tpep_dropoff_datetime,
    CASE WHEN l_orderkey % 499 = 0 THEN NULL WHEN l_orderkey % 101 = 0 THEN 99::BIGINT
      ELSE c_nationkey::BIGINT END AS PULocationID,
    CASE WHEN l_orderkey % 503 = 0 THEN NULL ELSE (l_suppkey % 25)::BIGINT END AS DOLocationID,
    CASE WHEN l_partkey % 6 = 0 THEN NULL WHEN l_partkey % 401 = 0 THEN 8::DOUBLE
      ELSE (l_linenumber - 1)::DOUBLE END AS passenger_count,
    CASE WHEN l_partkey % 307 = 0 THEN NULL ELSE (l_quantity - 1) / 2 END AS trip_distance,
    CASE WHEN l_partkey % 311 = 0 THEN NULL WHEN l_discount = 0.1::DOUBLE
      THEN -l_extendedprice / 1000 ELSE l_extendedprice / 1000 END AS fare_amount,
    l_tax AS tip_amount,
    CASE WHEN l_discount = 0.1::DOUBLE THEN -l_extendedprice * (1 + l_tax) / 1000
      ELSE l_extendedprice * (1 + l_tax) / 1000 END AS total_amount,
    (l_linenumber % 4)::DOUBLE AS payment_type,
    CASE WHEN l_returnflag = 'R' THEN NULL WHEN l_linestatus = 'O' THEN 2.5::DOUBLE
      ELSE 0::DOUBLE END AS congestion_surcharge,
    NULL::DOUBLE AS airport_fee,
    CASE WHEN year(l_shipdate) < 2000 OR l_returnflag = 'A' THEN NULL
      WHEN l_linestatus = 'O' THEN 0.75::DOUBLE ELSE 0::DOUBLE END AS cbd_congestion_fee
  FROM (
    SELECT *, year(l_shipdate)::INTEGER AS source_year, month(l_shipdate)::INTEGER AS source_month,
      l_shipdate::TIMESTAMP + to_days((CASE WHEN l_suppkey % 50 = 0 THEN 1 ELSE 0 END)::INTEGER)
        + to_minutes((l_orderkey * 37 + l_partkey * 11 + l_linenumber * 101) % 1440) AS p0
    FROM lineitem
      LEFT JOIN orders ON l_orderkey = o_orderkey
      LEFT JOIN customer ON o_custkey = c_custkey
  ) AS lines
),
zones AS (
  SELECT n_nationkey::BIGINT AS PULocationID,
    CASE WHEN n_nationkey = 23 THEN NULL ELSE r_name END AS pickup_Borough,
    CASE WHEN n_nationkey = 24 THEN NULL WHEN n_nationkey = 10 THEN 'NATION_5'
      ELSE n_name END AS pickup_Zone,
    'Zone ' || n_regionkey AS pickup_service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
prepared AS (
  SELECT *,
    coalesce(pickup_year = source_year AND pickup_month = source_month, false) AS source_month_match,
    coalesce(pickup_ts IS NOT NULL AND dropoff_ts IS NOT NULL AND dropoff_ts > pickup_ts
      AND pickup_year = source_year AND pickup_month = source_month
      AND PULocationID IS NOT NULL AND DOLocationID IS NOT NULL
      AND trip_duration_minutes > 0 AND trip_duration_minutes <= 240, false) AS structurally_valid
  FROM (
    SELECT * EXCLUDE (tpep_pickup_datetime, tpep_dropoff_datetime),
      tpep_pickup_datetime AS pickup_ts, tpep_dropoff_datetime AS dropoff_ts,
      year(tpep_pickup_datetime)::INTEGER AS pickup_year,
      month(tpep_pickup_datetime)::INTEGER AS pickup_month,
      hour(tpep_pickup_datetime)::INTEGER AS pickup_hour,
      strftime(tpep_pickup_datetime, '%Y-%m-%d') AS pickup_date,
      coalesce(isodow(tpep_pickup_datetime) >= 6, false) AS is_weekend,
      (epoch_us(tpep_dropoff_datetime) - epoch_us(tpep_pickup_datetime))::DOUBLE
        / 1000000 / 60 AS trip_duration_minutes,
      coalesce(trip_distance > 0, false) AS valid_distance,
      coalesce(fare_amount > 0, false) AS valid_fare,
      CASE WHEN trip_distance >= 20 THEN '20+' WHEN trip_distance >= 10 THEN '10-<20'
        WHEN trip_distance >= 5 THEN '5-<10' WHEN trip_distance >= 2 THEN '2-<5'
        WHEN trip_distance > 0 THEN '0-<2' ELSE 'Invalid/Non-positive' END AS distance_band,
      CASE WHEN passenger_count IS NULL THEN 'Missing'
        WHEN passenger_count IN (0, 1, 2, 3, 4, 5, 6) THEN passenger_count::INTEGER::VARCHAR
        ELSE '7+' END AS passenger_category
    FROM trips
  ) AS derived
),
valid AS (SELECT * FROM prepared WHERE structurally_valid),
named AS (SELECT * FROM valid LEFT JOIN zones USING (PULocationID)),
located AS (SELECT * FROM named WHERE pickup_Zone IS NOT NULL AND pickup_Borough IS NOT NULL),
bands AS (SELECT * FROM (VALUES (0, '0-<2'), (1, '2-<5'), (2, '5-<10'), (3, '10-<20'), (4, '20+'),
  (5, 'Invalid/Non-positive')) AS t(ord, distance_band)),
categories AS (SELECT * FROM (VALUES (0, 'Missing'), (1, '0'), (2, '1'), (3, '2'), (4, '3'),
  (5, '4'), (6, '5'), (7, '6'), (8, '7+')) AS t(ord, passenger_category)),
right_prepared AS (SELECT * FROM prepared WHERE coalesce(DOLocationID, -1) <> 24)
"""

DAYTYPE = "CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END"
MONTH = "printf('%d-%02d', source_year, source_month)"

MEANS = """round(avg(fare_amount) FILTER (valid_fare), 6) AS avg_valid_fare_amount,
  round(avg(trip_distance) FILTER (valid_distance), 6) AS avg_valid_trip_distance,
  round(avg(trip_duration_minutes), 6) AS avg_trip_duration_min"""

DEFECTS = """count(*) AS raw_rows,
  count(*) FILTER (pickup_ts IS NULL) AS null_pickup_timestamp,
  count(*) FILTER (dropoff_ts IS NULL) AS null_dropoff_timestamp,
  count(*) FILTER (dropoff_ts <= pickup_ts) AS dropoff_not_after_pickup,
  count(*) FILTER (trip_duration_minutes <= 0) AS duration_nonpositive,
  count(*) FILTER (trip_duration_minutes > 240) AS duration_over_240,
  count(*) FILTER (pickup_ts IS NOT NULL AND NOT source_month_match) AS source_month_mismatch,
  count(*) FILTER (PULocationID IS NULL) AS "null_PULocationID",
  count(*) FILTER (DOLocationID IS NULL) AS "null_DOLocationID",
  count(*) FILTER (trip_distance IS NULL OR trip_distance <= 0) AS nonpositive_distance,
  count(*) FILTER (fare_amount IS NULL OR fare_amount <= 0) AS nonpositive_fare,
  count(*) FILTER (passenger_count IS NULL) AS missing_passenger_count,
  count(*) FILTER (structurally_valid) AS structurally_valid_rows,
  count(*) FILTER (NOT structurally_valid) AS structurally_removed_rows,
  count(*) FILTER (structurally_valid AND pickup_Zone IS NULL) AS unmatched_pickup_lookup"""

QUALITY = f"""quality AS (
  SELECT {MONTH} AS month, source_year, source_month, {DEFECTS}
  FROM prepared LEFT JOIN zones USING (PULocationID) GROUP BY source_year, source_month)"""

MONTHLY = f"""monthly AS (
  SELECT source_year AS pickup_year, source_month AS pickup_month,
    count(*) FILTER (structurally_valid) AS trip_count,
    avg(fare_amount) FILTER (structurally_valid AND valid_fare) AS avg_valid_fare_amount,
    avg(total_amount) FILTER (structurally_valid AND valid_fare) AS avg_total_amount_for_valid_fare,
    avg(trip_distance) FILTER (structurally_valid AND valid_distance) AS avg_valid_trip_distance,
    avg(trip_duration_minutes) FILTER (structurally_valid) AS avg_trip_duration_min,
    avg(congestion_surcharge) FILTER (structurally_valid) AS avg_congestion_surcharge,
    count(*) FILTER (structurally_valid AND cbd_congestion_fee IS NOT NULL) > 0 AS cbd_fee_available,
    count(*) FILTER (structurally_valid AND cbd_congestion_fee > 0) AS cbd_fee_charged_trips,
    CASE WHEN count(*) FILTER (structurally_valid AND cbd_congestion_fee IS NOT NULL) > 0 THEN
      count(*) FILTER (structurally_valid AND cbd_congestion_fee > 0)::DOUBLE
        / count(*) FILTER (structurally_valid) * 100 END AS cbd_fee_charged_share_pct
  FROM prepared GROUP BY ALL)"""

MONTHLY_COLUMNS = """pickup_year, pickup_month, trip_count,
  round(avg_valid_fare_amount, 6) AS avg_valid_fare_amount,
  round(avg_total_amount_for_valid_fare, 6) AS avg_total_amount_for_valid_fare,
  round(avg_valid_trip_distance, 6) AS avg_valid_trip_distance,
  round(avg_trip_duration_min, 6) AS avg_trip_duration_min,
  round(avg_congestion_surcharge, 6) AS avg_congestion_surcharge,
  cbd_fee_available, cbd_fee_charged_trips,
  round(cbd_fee_charged_share_pct, 6) AS cbd_fee_charged_share_pct"""


def _common(source: str, where: str) -> str:
    """One-row common metrics of a prepared relation."""
    return f"""SELECT m.*, h.*, z.* FROM
  (SELECT CASE WHEN min({MONTH}) = max({MONTH}) THEN min({MONTH})
      ELSE min({MONTH}) || '_to_' || max({MONTH}) END AS source_period,
    CASE WHEN count(*) > 0 THEN count(*) END AS raw_rows,
    CASE WHEN count(*) > 0 THEN count(*) FILTER (structurally_valid) END AS valid_rows
    FROM {source} WHERE {where}) AS m
  LEFT JOIN (SELECT pickup_hour AS busiest_pickup_hour, count(*) AS busiest_pickup_hour_trips
    FROM {source} WHERE structurally_valid AND {where}
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1) AS h ON true
  LEFT JOIN (SELECT pickup_Borough AS top_pickup_borough, pickup_Zone AS top_pickup_zone,
      count(*) AS top_pickup_zone_trips
    FROM {source} JOIN zones USING (PULocationID)
    WHERE structurally_valid AND pickup_Zone IS NOT NULL AND pickup_Borough IS NOT NULL AND {where}
    GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 1) AS z ON true"""


def _bands(source: str, where: str) -> str:
    return f"""SELECT distance_band, count(structurally_valid) AS trip_count,
    avg(fare_amount) FILTER (valid_fare) AS avg_valid_fare_amount
  FROM bands LEFT JOIN (SELECT * FROM {source} WHERE structurally_valid AND {where}) AS v
    USING (distance_band) GROUP BY distance_band"""


PERIOD = "source_year = 1998 AND source_month = 1"
NO_PERIOD = "source_year = 2010 AND source_month = 1"


def _sides(where: str, suffix: str = "") -> str:
    return f"""left_common{suffix} AS ({_common("prepared", where)}),
right_common{suffix} AS ({_common("right_prepared", where)})"""


COUNT_STATUS = """CASE WHEN l IS NULL OR r IS NULL THEN 'PENDING'
    WHEN l = r THEN 'PASS' ELSE 'FAIL' END AS status"""


def _counts(pairs: str) -> str:
    return f"""SELECT metric, coalesce(l::VARCHAR, 'N/A') AS left_result,
  coalesce(r::VARCHAR, 'N/A') AS right_result, coalesce((r - l)::VARCHAR, '') AS difference,
  'Exact' AS rule, {COUNT_STATUS},
  CASE WHEN l IS NULL OR r IS NULL THEN 'One side has no valid-row count for this period.'
    WHEN l = r THEN '' ELSE 'Look at structural filtering and the source-month rule.' END
    AS explanation
FROM ({pairs}) AS pairs"""


def _ranked(metric: str, left: str, right: str, kind: str) -> str:
    """Comparison of (name, trips) pairs taken from two one-row relations."""
    if kind == "hour":
        name, trips = "busiest_pickup_hour", "busiest_pickup_hour_trips"
        rule, mismatch = "Same hour and count", "FAIL"
        pending, hint = "One side has no hourly result for this period.", ""
    else:
        name, trips = "top_pickup_zone", "top_pickup_zone_trips"
        rule, mismatch = "Same zone and count, except documented ties", "REVIEW"
        pending = "One side has no zone result for this period."
        hint = "Look at zone naming and tied zones."

    def text(side: str) -> str:
        shown = (
            f"printf('%02d:00', {side}.{name})" if kind == "hour" else f"{side}.{name}"
        )
        return f"{shown} || ' (' || format('{{:,}}', {side}.{trips}) || ' trips)'"

    missing = f"l.{trips} IS NULL OR r.{trips} IS NULL"
    same = f"l.{name} = r.{name} AND l.{trips} = r.{trips}"
    return f"""SELECT '{metric}' AS metric, coalesce({text("l")}, 'N/A') AS left_result,
  coalesce({text("r")}, 'N/A') AS right_result, '' AS difference, '{rule}' AS rule,
  CASE WHEN {missing} THEN 'PENDING' WHEN {same} THEN 'PASS' ELSE '{mismatch}' END AS status,
  CASE WHEN {missing} THEN '{pending}' WHEN {same} THEN '' ELSE '{hint}' END AS explanation
FROM {left} AS l, {right} AS r"""


def _band_report(left: str, right: str) -> str:
    return f"""SELECT 'Average fare - ' || distance_band AS metric,
  coalesce(printf('%.6f', l.fare), 'N/A') AS left_result,
  coalesce(printf('%.6f', r.fare), 'N/A') AS right_result,
  coalesce(printf('%.6f', abs(l.fare - r.fare)), '') AS difference,
  'Absolute difference <= 0.01' AS rule,
  CASE WHEN l.fare IS NULL OR r.fare IS NULL THEN 'REVIEW'
    WHEN abs(l.fare - r.fare) <= 0.01::DOUBLE THEN 'PASS' ELSE 'FAIL' END AS status,
  '' AS explanation
FROM (SELECT distance_band, avg_valid_fare_amount AS fare FROM ({left}) AS a) AS l
  FULL JOIN (SELECT distance_band, avg_valid_fare_amount AS fare FROM ({right}) AS b) AS r
  USING (distance_band)"""


def _valid_pair(suffix: str = "") -> str:
    return f"""SELECT 'Structurally valid rows' AS metric, l.valid_rows AS l, r.valid_rows AS r
  FROM left_common{suffix} AS l, right_common{suffix} AS r"""


def _report(suffix: str = "") -> str:
    return f"""{_counts(_valid_pair(suffix))}
UNION ALL {_ranked("Busiest pickup hour", f"left_common{suffix}", f"right_common{suffix}", "hour")}
UNION ALL {_ranked("Top pickup zone", f"left_common{suffix}", f"right_common{suffix}", "zone")}"""


MEDIAN = """SELECT distance_band, round(median(fare_amount), 6) AS median_valid_fare_amount
FROM bands LEFT JOIN (SELECT distance_band, fare_amount FROM valid WHERE valid_fare) AS v
  USING (distance_band) GROUP BY distance_band"""

SPINE = """spine AS (
  SELECT row_number() OVER (ORDER BY d)::INTEGER AS month_index, year(d)::INTEGER AS source_year,
    month(d)::INTEGER AS source_month, strftime(d, '%Y-%m') AS month
  FROM (SELECT unnest(generate_series(
      (SELECT min(make_date(source_year, source_month, 1)) FROM trips)::TIMESTAMP,
      (SELECT make_date(max(source_year), 12, 1) FROM trips)::TIMESTAMP,
      INTERVAL 1 MONTH)) AS d) AS days)"""

SWEEP = f"""{SPINE},
scales AS (SELECT unnest([1, 3, 6, 12, 24, 84]) AS months),
per_month AS (SELECT source_year, source_month,
    count(*) FILTER (structurally_valid) AS n FROM prepared GROUP BY ALL),
reached AS (SELECT months, month_index, month, n FROM scales JOIN spine ON month_index <= months
  LEFT JOIN per_month USING (source_year, source_month)),
totals AS (SELECT months, sum(n)::BIGINT AS valid_rows, count(n) AS files_read,
    min(month) AS first_file, max(month) AS last_file,
    min(month) FILTER (n IS NULL) AS absent FROM reached GROUP BY months),
locations AS (SELECT months, PULocationID, pickup_Borough, pickup_Zone, count(*) AS trips
  FROM named JOIN spine USING (source_year, source_month) JOIN scales ON month_index <= months
  WHERE pickup_Zone IS NOT NULL GROUP BY ALL),
tops AS (SELECT months, pickup_Zone AS top_pickup_zone, trips AS top_pickup_zone_trips
  FROM (SELECT *, row_number() OVER (PARTITION BY months
    ORDER BY trips DESC, pickup_Borough ASC NULLS LAST, pickup_Zone, PULocationID) AS place
    FROM locations) AS ranked WHERE place = 1),
sweep AS (SELECT months,
    CASE WHEN months = 84 THEN first_file || ' to ' || last_file
      WHEN files_read = months THEN printf('first %d month(s) from %s', months, first_file)
      ELSE printf('first %d month(s)', months) END AS period,
    CASE WHEN files_read = months THEN 'SUCCESS' ELSE 'SKIPPED' END AS status,
    CASE WHEN files_read = months THEN valid_rows END AS valid_rows,
    CASE WHEN files_read = months THEN files_read END AS files_read,
    CASE WHEN files_read = months THEN first_file END AS first_file,
    CASE WHEN files_read = months THEN last_file END AS last_file,
    CASE WHEN files_read = months THEN top_pickup_zone END AS top_pickup_zone,
    CASE WHEN files_read = months THEN top_pickup_zone_trips END AS top_pickup_zone_trips,
    CASE WHEN files_read = months THEN '' ELSE 'Missing file: ' || absent END AS result_or_error
  FROM totals LEFT JOIN tops USING (months))"""

STATES = """count(*) AS trip_count,
  round(sum(fare_amount) FILTER (valid_fare), 7) AS fare_sum,
  count(*) FILTER (valid_fare) AS fare_count,
  round(sum(total_amount) FILTER (valid_fare), 7) AS total_sum,
  count(total_amount) FILTER (valid_fare) AS total_count,
  round(sum(trip_distance) FILTER (valid_distance), 7) AS distance_sum,
  count(*) FILTER (valid_distance) AS distance_count,
  round(sum(trip_duration_minutes), 6) AS duration_sum,
  count(trip_duration_minutes) AS duration_count,
  round(sum(congestion_surcharge), 7) AS surcharge_sum,
  count(congestion_surcharge) AS surcharge_count,
  round(sum(fare_amount / trip_distance) FILTER (valid_fare AND valid_distance), 6) AS per_mile_sum,
  count(*) FILTER (valid_fare AND valid_distance) AS per_mile_count,
  count(cbd_congestion_fee) AS cbd_reported,
  count(*) FILTER (cbd_congestion_fee > 0) AS cbd_charged"""

DAY_SUMMARY = f"""
day_counts AS (SELECT is_weekend, pickup_date, count(*) AS n FROM valid GROUP BY ALL),
hour_counts AS (SELECT is_weekend, pickup_hour, count(*) AS n FROM valid GROUP BY ALL),
day_totals AS (SELECT is_weekend, count(*) AS number_of_days, sum(n)::BIGINT AS trip_count
  FROM day_counts GROUP BY ALL),
peaks AS (SELECT is_weekend, pickup_hour AS peak_hour, n AS peak_hour_total_trips FROM (
  SELECT *, row_number() OVER (PARTITION BY is_weekend ORDER BY n DESC, pickup_hour) AS place
  FROM hour_counts) AS ranked WHERE place = 1),
day_zones AS (SELECT is_weekend, pickup_Borough AS top_pickup_borough,
    pickup_Zone AS top_pickup_zone, n AS top_pickup_zone_trips FROM (
  SELECT *, row_number() OVER (PARTITION BY is_weekend
    ORDER BY n DESC, pickup_Borough, pickup_Zone) AS place
  FROM (SELECT is_weekend, pickup_Borough, pickup_Zone, count(*) AS n FROM located GROUP BY ALL)
    AS counted) AS ranked WHERE place = 1),
day_means AS (SELECT is_weekend, {MEANS} FROM valid GROUP BY is_weekend)"""


def _with(select: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([TRIPS.strip(), *ctes]) + "\n" + select


def statements() -> dict[str, str]:
    return {
        "scan_trips": _with(
            """SELECT source_year, source_month, count(*) AS raw_rows,
  count(tpep_pickup_datetime) AS pickups, count(tpep_dropoff_datetime) AS dropoffs,
  sum(PULocationID)::BIGINT AS "PULocationID", sum(DOLocationID)::BIGINT AS "DOLocationID",
  round(sum(passenger_count), 7) AS passenger_count, round(sum(trip_distance), 8) AS trip_distance,
  round(sum(fare_amount), 7) AS fare_amount, round(sum(tip_amount), 8) AS tip_amount,
  round(sum(total_amount), 7) AS total_amount, round(sum(payment_type), 8) AS payment_type,
  round(sum(congestion_surcharge), 7) AS congestion_surcharge,
  count(airport_fee) AS airport_fee, round(sum(cbd_congestion_fee), 7) AS cbd_congestion_fee
FROM trips GROUP BY source_year, source_month"""
        ),
        "source_period": _with(
            """SELECT regexp_extract(file_name, 'yellow_tripdata_(\\d{4})-(\\d{2})\\.parquet$', 1)
    ::INTEGER AS source_year,
  regexp_extract(file_name, 'yellow_tripdata_(\\d{4})-(\\d{2})\\.parquet$', 2)
    ::INTEGER AS source_month, count(*) AS raw_rows
FROM (SELECT printf('yellow_tripdata_%d-%02d.parquet', source_year, source_month) AS file_name
  FROM trips) AS files GROUP BY ALL"""
        ),
        "month_spine": _with("SELECT * FROM spine", SPINE),
        "missing_months": _with(
            """SELECT * FROM spine WHERE NOT EXISTS (SELECT 1 FROM trips
  WHERE trips.source_year = spine.source_year AND trips.source_month = spine.source_month)""",
            SPINE,
        ),
        "zone_dim": _with("SELECT * FROM zones"),
        "dim_key_violations": _with(
            """SELECT n_nationkey::BIGINT AS "PULocationID", 2::BIGINT AS rows
FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 3 = 0"""
        ),
        "prepared_trips": _with(
            """SELECT source_year, source_month, pickup_year, pickup_month, pickup_date, pickup_hour,
  is_weekend, round(trip_duration_minutes, 6) AS trip_duration_minutes, source_month_match,
  valid_distance, valid_fare, structurally_valid FROM prepared"""
        ),
        "distance_band": _with(
            """SELECT trip_distance, distance_band, count(*) AS raw_rows
FROM prepared GROUP BY ALL"""
        ),
        "passenger_category": _with(
            """SELECT passenger_count, passenger_category, count(*) AS raw_rows
FROM prepared GROUP BY ALL"""
        ),
        "structurally_valid": _with(
            """SELECT source_year, source_month, pickup_date, count(*) AS trip_count,
  sum(PULocationID)::BIGINT AS "PULocationID", sum(DOLocationID)::BIGINT AS "DOLocationID"
FROM valid GROUP BY source_year, source_month, pickup_date"""
        ),
        "zone_join": _with(
            """SELECT PULocationID AS "PULocationID", pickup_Borough AS "pickup_Borough",
  pickup_Zone AS "pickup_Zone", pickup_service_zone, DOLocationID AS "DOLocationID", pickup_hour
FROM named"""
        ),
        "monthly_quality": _with(
            "SELECT * EXCLUDE (source_year, source_month) FROM quality", QUALITY
        ),
        "period_totals": _with(
            """SELECT count(*) AS months_processed, sum(raw_rows)::BIGINT AS raw_rows,
  sum(structurally_valid_rows)::BIGINT AS valid_rows FROM quality""",
            QUALITY,
        ),
        "hourly_demand": _with(
            "SELECT pickup_hour, count(*) AS trip_count FROM valid GROUP BY pickup_hour"
        ),
        "busiest_hour": _with(
            """SELECT pickup_hour, count(*) AS trip_count FROM valid GROUP BY pickup_hour
ORDER BY trip_count DESC, pickup_hour LIMIT 1"""
        ),
        "zone_demand": _with(
            """SELECT pickup_Borough AS "pickup_Borough", pickup_Zone AS "pickup_Zone",
  count(*) AS trip_count FROM located GROUP BY 1, 2"""
        ),
        "top_zones": _with(
            """SELECT pickup_Borough AS "pickup_Borough", pickup_Zone AS "pickup_Zone",
  count(*) AS trip_count FROM located GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20"""
        ),
        "top_zone": _with(
            """SELECT pickup_Borough AS "pickup_Borough", pickup_Zone AS "pickup_Zone",
  count(*) AS trip_count FROM located GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 1"""
        ),
        "zone_demand_by_id": _with(
            """SELECT PULocationID AS "PULocationID", pickup_Borough AS "pickup_Borough",
  pickup_Zone AS "pickup_Zone", pickup_service_zone, count(*) AS trip_count
FROM named WHERE pickup_Zone IS NOT NULL GROUP BY 1, 2, 3, 4"""
        ),
        "top_zone_by_id": _with(
            """SELECT PULocationID AS "PULocationID", pickup_Borough AS "pickup_Borough",
  pickup_Zone AS "pickup_Zone", pickup_service_zone, count(*) AS trip_count
FROM named WHERE pickup_Zone IS NOT NULL GROUP BY 1, 2, 3, 4
ORDER BY 5 DESC, 2 ASC NULLS LAST, 3, 1 LIMIT 1"""
        ),
        "common_metrics": _with(
            f"""SELECT c.source_period,
  (SELECT count(DISTINCT {MONTH}) FROM prepared) AS months_processed,
  c.* EXCLUDE (source_period) FROM ({_common("prepared", "true")}) AS c"""
        ),
        "period_common_metrics": _with(_common("prepared", PERIOD)),
        "period_distance_summary": _with(
            f"""SELECT distance_band, trip_count,
  round(avg_valid_fare_amount, 6) AS avg_valid_fare_amount
FROM ({_bands("prepared", PERIOD)}) AS b"""
        ),
        "distance_fare_summary": _with(
            """SELECT distance_band, count(structurally_valid) AS trip_count,
  round(avg(fare_amount) FILTER (valid_fare), 6) AS avg_valid_fare_amount,
  round(median(fare_amount) FILTER (valid_fare), 6) AS median_valid_fare_amount,
  round(avg(total_amount) FILTER (valid_fare), 6) AS avg_total_amount_for_valid_fare,
  round(avg(trip_duration_minutes), 6) AS avg_trip_duration_min,
  round(avg(fare_amount / trip_distance) FILTER (valid_fare AND valid_distance), 6)
    AS avg_fare_per_mile
FROM bands LEFT JOIN valid USING (distance_band) GROUP BY distance_band"""
        ),
        "band_median_fare": _with(MEDIAN),
        "band_median_fare_hist": _with(MEDIAN),
        "passenger_summary": _with(
            f"""SELECT passenger_category, count(structurally_valid) AS trip_count,
  round(count(structurally_valid)::DOUBLE / (SELECT count(*) FROM valid) * 100, 6) AS share_pct,
  {MEANS}
FROM categories LEFT JOIN valid USING (passenger_category) GROUP BY passenger_category"""
        ),
        "single_vs_multiple": _with(
            f"""SELECT CASE WHEN passenger_category = '1' THEN 'Single passenger'
    ELSE 'Multiple passengers (2-6)' END AS passenger_group, count(*) AS trip_count,
  round(count(*)::DOUBLE / (SELECT count(*) FROM valid
    WHERE passenger_category IN ('1', '2', '3', '4', '5', '6')) * 100, 6)
    AS share_of_valid_1_to_6_pct,
  {MEANS}
FROM valid WHERE passenger_category IN ('1', '2', '3', '4', '5', '6') GROUP BY 1"""
        ),
        "daily_demand": _with(
            f"""SELECT {DAYTYPE} AS day_type, pickup_date, count(*) AS trip_count
FROM valid GROUP BY 1, 2"""
        ),
        "weekday_weekend_hourly": _with(
            f"""SELECT {DAYTYPE} AS day_type, pickup_hour, n AS total_trips, number_of_days,
  round(n::DOUBLE / number_of_days, 6) AS avg_daily_trips
FROM hour_counts JOIN day_totals USING (is_weekend)""",
            DAY_SUMMARY,
        ),
        "weekday_weekend_metrics": _with(
            f"""SELECT {DAYTYPE} AS day_type, count(*) AS trip_count, {MEANS}
FROM valid GROUP BY 1"""
        ),
        "weekday_weekend_summary": _with(
            f"""SELECT {DAYTYPE} AS day_type, trip_count, number_of_days,
  round(trip_count::DOUBLE / number_of_days, 6) AS avg_daily_trips,
  peak_hour, peak_hour_total_trips,
  round(peak_hour_total_trips::DOUBLE / number_of_days, 6) AS peak_hour_avg_daily_trips,
  top_pickup_borough, top_pickup_zone, top_pickup_zone_trips,
  avg_valid_fare_amount, avg_valid_trip_distance, avg_trip_duration_min
FROM day_totals JOIN peaks USING (is_weekend) JOIN day_zones USING (is_weekend)
  JOIN day_means USING (is_weekend)""",
            DAY_SUMMARY,
        ),
        "peak_hour_by_daytype": _with(
            f"SELECT {DAYTYPE} AS day_type, peak_hour, peak_hour_total_trips FROM peaks", DAY_SUMMARY
        ),
        "top_zone_by_daytype": _with(
            f"""SELECT {DAYTYPE} AS day_type, top_pickup_borough, top_pickup_zone,
  top_pickup_zone_trips FROM day_zones""",
            DAY_SUMMARY,
        ),
        "monthly_demand": _with(
            "SELECT pickup_year, pickup_month, trip_count FROM monthly", MONTHLY
        ),
        "monthly_comparison": _with(f"SELECT {MONTHLY_COLUMNS} FROM monthly", MONTHLY),
        "monthly_cbd_fee": _with(
            """SELECT pickup_year, pickup_month, cbd_fee_available, cbd_fee_charged_trips,
  round(cbd_fee_charged_share_pct, 6) AS cbd_fee_charged_share_pct FROM monthly""",
            MONTHLY,
        ),
        "monthly_avg_daily": _with(
            f"""SELECT {MONTHLY_COLUMNS},
  day(last_day(make_date(pickup_year, pickup_month, 1)))::INTEGER AS days_in_month,
  round(trip_count::DOUBLE / day(last_day(make_date(pickup_year, pickup_month, 1))), 6)
    AS avg_daily_trips FROM monthly""",
            MONTHLY,
        ),
        "year_summary": _with(
            """SELECT pickup_year, sum(trip_count)::BIGINT AS total_valid_trips,
  round(sum(trip_count)::DOUBLE / dayofyear(make_date(pickup_year, 12, 31)), 6) AS avg_daily_trips,
  arg_min(pickup_month, struct_pack(n := -trip_count, m := pickup_month)) AS peak_month,
  max(trip_count) AS peak_monthly_trips,
  round(CASE WHEN count(avg_valid_fare_amount) = count(*) THEN
    sum(avg_valid_fare_amount * trip_count) / sum(trip_count) END, 6)
    AS avg_monthly_valid_fare_amount,
  round(CASE WHEN count(avg_total_amount_for_valid_fare) = count(*) THEN
    sum(avg_total_amount_for_valid_fare * trip_count) / sum(trip_count) END, 6)
    AS avg_monthly_total_amount,
  round(sum(coalesce(avg_congestion_surcharge, 0) * trip_count) / sum(trip_count), 6)
    AS avg_congestion_surcharge,
  sum(cbd_fee_charged_trips)::BIGINT AS cbd_fee_charged_trips
FROM monthly GROUP BY pickup_year""",
            MONTHLY,
        ),
        "rollup_merge": _with(
            f"""SELECT distance_band, passenger_category, {STATES}
FROM valid GROUP BY distance_band, passenger_category"""
        ),
        "scale_sweep": _with("SELECT * FROM sweep", SWEEP),
        "series_scale": _with(
            "SELECT * EXCLUDE (status, result_or_error) FROM sweep WHERE status = 'SUCCESS'", SWEEP
        ),
        "period_select": _with(
            """SELECT 'month text' AS layout, structurally_valid_rows AS valid_rows FROM quality
  WHERE month = '1998-01'
UNION ALL SELECT 'pickup_year, pickup_month', structurally_valid_rows FROM quality
  WHERE source_year = 1998 AND source_month = 1
UNION ALL SELECT 'year, month', structurally_valid_rows FROM quality
  WHERE source_year = 1998 AND source_month = 1""",
            QUALITY,
        ),
        "resolve_columns": _with(
            """SELECT 'hour' AS source, pickup_hour::VARCHAR AS name, count(*) AS trips
  FROM valid GROUP BY pickup_hour
UNION ALL SELECT 'zone', pickup_Zone, count(*) FROM located GROUP BY pickup_Zone, pickup_Borough"""
        ),
        "reconcile_counts": _with(
            _counts(
                f"""SELECT metric, l, r FROM
  (SELECT {MONTH} AS metric, count(*) FILTER (structurally_valid) AS l FROM prepared GROUP BY 1) AS x
  FULL JOIN
  (SELECT {MONTH} AS metric, count(*) FILTER (structurally_valid) AS r FROM right_prepared
    GROUP BY 1) AS y USING (metric)"""
            )
        ),
        "reconcile_hour": _with(
            _ranked("Busiest pickup hour", "left_common", "right_common", "hour")
            + "\nUNION ALL "
            + _ranked("Busiest pickup hour", "left_common", "right_common_none", "hour"),
            _sides(PERIOD),
            _sides(NO_PERIOD, "_none"),
        ),
        "reconcile_zone": _with(
            _ranked("Top pickup zone", "left_common", "right_common", "zone")
            + "\nUNION ALL "
            + _ranked("Top pickup zone", "left_common", "right_common_none", "zone"),
            _sides(PERIOD),
            _sides(NO_PERIOD, "_none"),
        ),
        "reconcile_band_fares": _with(
            _band_report(_bands("prepared", PERIOD), _bands("right_prepared", PERIOD))
        ),
        "reconcile_fallback": _with(_report(), _sides(PERIOD)),
        "reconcile_report": _with(
            f"""SELECT '1998-01' AS period, * FROM ({_report()}
UNION ALL {_band_report(_bands("prepared", PERIOD), _bands("right_prepared", PERIOD))}) AS a
UNION ALL SELECT '2010-01' AS period, * FROM ({_report("_none")}
UNION ALL SELECT 'Average fare by distance band', 'N/A', 'N/A', '', 'Absolute difference <= 0.01',
  'PENDING', 'One side has no distance-band result for this period.') AS b""",
            _sides(PERIOD),
            _sides(NO_PERIOD, "_none"),
        ),
        "series_band_fares": _with(
            """SELECT distance_band, count(structurally_valid) AS trip_count,
  round(avg(fare_amount) FILTER (valid_fare), 6) AS avg_valid_fare_amount,
  round(median(fare_amount) FILTER (valid_fare), 6) AS median_valid_fare_amount,
  round(avg(total_amount) FILTER (valid_fare), 6) AS avg_total_amount_for_valid_fare,
  round(avg(trip_duration_minutes), 6) AS avg_trip_duration_min,
  round(avg(fare_amount / trip_distance) FILTER (valid_fare AND valid_distance), 6)
    AS avg_fare_per_mile
FROM bands LEFT JOIN valid USING (distance_band)
WHERE distance_band <> 'Invalid/Non-positive' GROUP BY distance_band"""
        ),
        "series_daytype_hourly": _with(
            """SELECT pickup_hour,
  round(max(n::DOUBLE / number_of_days) FILTER (NOT is_weekend), 6) AS "Weekday",
  round(max(n::DOUBLE / number_of_days) FILTER (is_weekend), 6) AS "Weekend"
FROM hour_counts JOIN day_totals USING (is_weekend) GROUP BY pickup_hour""",
            DAY_SUMMARY,
        ),
        "series_month_volume": _with(_by_year("trip_count"), MONTHLY),
        "series_month_avg_daily": _with(
            _by_year(
                "round(trip_count::DOUBLE / day(last_day(make_date(pickup_year, pickup_month, 1))), 6)"
            ),
            MONTHLY,
        ),
        "series_month_fare": _with(_by_year("round(avg_valid_fare_amount, 6)"), MONTHLY),
        "series_cbd_share": _with(
            """SELECT pickup_year, pickup_month,
  round(cbd_fee_charged_share_pct, 6) AS cbd_fee_charged_share_pct
FROM monthly WHERE cbd_fee_charged_share_pct IS NOT NULL""",
            MONTHLY,
        ),
    }


def _by_year(value: str) -> str:
    years = ",\n  ".join(
        f'max({value}) FILTER (pickup_year = {year}) AS "{year}"' for year in range(1995, 2002)
    )
    return f"SELECT pickup_month,\n  {years}\nFROM monthly GROUP BY pickup_month"
