"""Distance-band fares and exact medians."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.contract import DEFAULT, TripContract
from tripmart.operators.cells import mean, merge_cells
from tripmart.operators.spine import with_domain

#: Bits that a round of :func:`weighted_median` finds, and bits of a double's fraction.
_DIGIT_BITS, _FRACTION_BITS = 22, 52


def fare_histogram(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Positive fares as (keys, fare_amount, trips): a mergeable median state.

    Takes cells of single trips: the sum of several fares is no fare, so a cell
    that counts more than one raises an error.  A cell that counts no fare falls into a group without trips, dropped after
    the aggregation.
    """
    fare = F.when(
        F.col("fare_count") > 1, F.raise_error(F.lit("a fare histogram needs cells of single trips"))
    ).otherwise(F.col("fare_sum"))
    return (
        cells.groupBy(*keys, fare.alias("fare_amount"))
        .agg(F.sum("fare_count").alias("trips"))
        .filter(F.col("trips") > 0)
    )


def merge_histograms(histograms: DataFrame, keys: list[str]) -> DataFrame:
    return histograms.groupBy(*keys, "fare_amount").agg(F.sum("trips").alias("trips"))


def fare_states(cells: DataFrame, keys: list[str]) -> DataFrame:
    """The summary's states by (keys, fare): means and the median of one aggregate.

    ``trips`` counts the fares, as in :func:`fare_histogram`; trips without a counted fare
    share the row with a null one.  What fare and trips tell is no state of its own.
    """
    fare = F.when(F.col("fare_count") > 0, F.col("fare_sum"))
    states = [f"{name}_{part}" for name in ("total", "duration", "per_mile") for part in ("sum", "count")]
    return (
        cells.groupBy(*keys, fare.alias("fare_amount"))
        .agg(
            *[F.sum(name).alias(name) for name in ("trip_count", *states)],
            F.sum("fare_count").alias("trips"),
        )
        .withColumns({"fare_sum": F.col("fare_amount") * F.col("trips"), "fare_count": F.col("trips")})
    )


def _place(value: Column) -> Column:
    """A long that orders positive doubles as they are: exponent, then 52 bits of fraction.

    Powers of two scale exactly, so no two values share a place.
    """
    rough = F.floor(F.log2(value))
    power = F.pow(F.lit(2.0), rough)
    # log2 may round up to the next power, or down from it.
    exponent = (
        F.when(power > value, rough - 1).when(value / power >= 2, rough + 1).otherwise(rough)
    )
    fraction = value / F.pow(F.lit(2.0), exponent) - 1
    unit = 1 << _FRACTION_BITS
    place = exponent * F.lit(unit) + (fraction * F.lit(float(unit))).cast("bigint")
    # Beyond every finite place.  Never null, so that the joins on its digits add no null
    # test, which would be pushed through the grouping of fares into the scan of trips.
    return F.coalesce(F.when(value == float("inf"), F.lit(1024 * unit)).otherwise(place), F.lit(0))


def _reach(digits: Column, rank: Column) -> Column:
    """The digit that holds a rank, what lies before it, and its least value.

    ``digits`` is a sorted array of (digit, trips, value).
    """
    start = F.struct(
        F.lit(0).cast("bigint").alias("seen"),
        F.lit(0).cast("bigint").alias("before"),
        F.lit(None).cast("bigint").alias("digit"),
        F.lit(None).cast("double").alias("value"),
    )

    def step(held: Column, one: Column) -> Column:
        here = held["digit"].isNull() & (held["seen"] + one["trips"] >= rank)
        return F.struct(
            (held["seen"] + one["trips"]).alias("seen"),
            F.when(here, held["seen"]).otherwise(held["before"]).alias("before"),
            F.when(here, one["digit"]).otherwise(held["digit"]).alias("digit"),
            F.when(here, one["value"]).otherwise(held["value"]).alias("value"),
        )

    return F.aggregate(digits, start, step)


def weighted_median(
    histogram: DataFrame,
    key: str,
    value: str = "fare_amount",
    weight: str = "trips",
    sums: list[str] | None = None,
) -> DataFrame:
    """Exact median per key of a histogram of positive values.

    ``percentile`` would hold every distinct value of a key in one task.  Here the middle
    ranks are searched digit by digit in the bits of the values: a round counts the next
    ``_DIGIT_BITS`` bits of the values that share the digits found so far, at most
    2 ** _DIGIT_BITS counters a rank, combined before their shuffle, and finds the digit
    that holds the rank.  No values are ordered, however many fall close together.  The two
    middle values are averaged.  ``histogram`` has one row per (key, value).

    Columns named in ``sums`` are summed per key in the first round; rows without weight take
    part in these, and then a key without any weight has a row with a null median.
    """
    sums = sums or []
    rows = histogram.select(
        key,
        F.col(value).alias("value"),
        F.col(weight).cast("bigint").alias("trips"),
        _place(F.col(value)).alias("place"),
        *sums,
    )
    if sums:
        # A test that every row passes, on all columns: otherwise later rounds would carry
        # fewer columns than the first, so that their common exchange could not be reused
        # and the trips below it would be scanned for each round.
        unknown = [F.col(name).isNull().cast("int") for name in ("trips", *sums)]
        rows = rows.filter(F.greatest(*unknown) < 2)
    else:
        rows = rows.filter("trips > 0")
    totals = [F.sum(name).alias(name) for name in sums]
    first = targets = None
    for shift in range(2 * _DIGIT_BITS, -1, -_DIGIT_BITS):
        digit = F.shiftright("place", shift).alias("digit")
        if targets is None:
            keys, candidates, extra = [key], rows, totals
        else:
            keys, extra = [key, "target", "rank"], []
            above = F.shiftright("place", shift + _DIGIT_BITS)
            own = rows.filter("trips > 0").drop(*sums).withColumn("found", above)
            candidates = own.join(targets, [key, "found"])
        listed = (
            candidates.groupBy(*keys, digit)
            .agg(F.sum("trips").alias("trips"), F.min("value").alias("value"), *extra)
            .groupBy(*keys)
            .agg(
                F.array_sort(F.collect_list(F.struct("digit", "trips", "value"))).alias("digits"),
                F.sum("trips").alias("total"),
                *extra,
            )
        )
        if targets is None:
            first = listed
            ranks = [F.floor((F.col("total") + k) / 2) for k in (1, 2)]
            listed = listed.select("*", F.posexplode(F.array(*ranks)).alias("target", "rank"))
        reached = _reach(F.col("digits"), F.col("rank"))
        targets = listed.select(key, "target", "rank", reached.alias("reached")).select(
            key,
            "target",
            (F.col("rank") - F.col("reached.before")).alias("rank"),
            F.col("reached.digit").alias("found"),
            F.col("reached.value").alias("value"),
        )
        if shift:
            targets = targets.drop("value")
    medians = targets.groupBy(key).agg(F.avg("value").alias("median"))
    return first.select(key, *sums).join(medians, key, "left") if sums else medians


def band_median_fare(
    histogram: DataFrame, contract: TripContract = DEFAULT
) -> DataFrame:
    """Median positive fare per band, every band present."""
    medians = weighted_median(histogram, "distance_band").withColumnRenamed(
        "median", "median_valid_fare_amount"
    )
    filled = with_domain(medians, "distance_band", contract.band_labels, [])
    return filled.orderBy("ord").select("distance_band", "median_valid_fare_amount")


def distance_fare_summary(
    cells: DataFrame, histogram: DataFrame, contract: TripContract = DEFAULT
) -> DataFrame:
    """Counts, means and the exact median fare per distance band."""
    medians = weighted_median(histogram, "distance_band")
    bands = merge_cells(cells, ["distance_band"])
    # Both sides hold at most one row per band.
    return _summary(bands.join(F.broadcast(medians), "distance_band", "left"), contract)


def distance_fares_in_one_scan(cells: DataFrame, contract: TripContract = DEFAULT) -> DataFrame:
    """The same from trips: means and medians come from one aggregate of them."""
    states = fare_states(cells, ["distance_band"])
    sums = [name for name in states.columns if name.endswith(("_sum", "_count"))]
    return _summary(weighted_median(states, "distance_band", sums=sums), contract)


def _summary(bands: DataFrame, contract: TripContract) -> DataFrame:
    filled = with_domain(bands, "distance_band", contract.band_labels, ["trip_count"])
    return filled.orderBy("ord").select(
        "distance_band",
        "trip_count",
        mean("fare").alias("avg_valid_fare_amount"),
        F.col("median").alias("median_valid_fare_amount"),
        mean("total").alias("avg_total_amount_for_valid_fare"),
        mean("duration").alias("avg_trip_duration_min"),
        mean("per_mile").alias("avg_fare_per_mile"),
    )


def period_distance_summary(cells: DataFrame, contract: TripContract = DEFAULT) -> DataFrame:
    """Count and mean positive fare per band."""
    bands = merge_cells(cells, ["distance_band"], ["trip_count", "fare_sum", "fare_count"])
    filled = with_domain(bands, "distance_band", contract.band_labels, ["trip_count"])
    return filled.orderBy("ord").select(
        "distance_band", "trip_count", mean("fare").alias("avg_valid_fare_amount")
    )
