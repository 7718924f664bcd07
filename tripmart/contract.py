"""The trip-table contract: columns, category domains and limits.

Everything here is a parameter.  Operators take a :class:`TripContract`, so a
caller with other column names, bands or limits passes another instance.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TripContract:
    # ---- fixed values: these decide results and file compatibility ----------
    pickup: str = "tpep_pickup_datetime"
    dropoff: str = "tpep_dropoff_datetime"
    ids: tuple[str, ...] = ("PULocationID", "DOLocationID")
    measures: tuple[str, ...] = (
        "passenger_count",
        "trip_distance",
        "fare_amount",
        "tip_amount",
        "total_amount",
        "payment_type",
        "congestion_surcharge",
    )
    optional_measures: tuple[str, ...] = ("airport_fee", "cbd_congestion_fee")

    #: (lower bound, label); a band reaches up to the next lower bound.  The
    #: first band excludes its lower bound (a zero distance is not a distance).
    distance_bands: tuple[tuple[float, str], ...] = (
        (0.0, "0-<2"),
        (2.0, "2-<5"),
        (5.0, "5-<10"),
        (10.0, "10-<20"),
        (20.0, "20+"),
    )
    no_distance_band: str = "Invalid/Non-positive"

    missing_passengers: str = "Missing"
    exact_passengers: tuple[int, ...] = (0, 1, 2, 3, 4, 5, 6)
    other_passengers: str = "7+"
    #: group label -> passenger categories it merges
    passenger_groups: tuple[tuple[str, tuple[str, ...]], ...] = (
        ("Single passenger", ("1",)),
        ("Multiple passengers (2-6)", ("2", "3", "4", "5", "6")),
    )

    max_duration_minutes: float = 240.0
    weekday_label: str = "Weekday"
    weekend_label: str = "Weekend"
    top_zone_rows: int = 20
    scales: tuple[int, ...] = (1, 3, 6, 12, 24)

    #: Period in a monthly file name.  A month may be one file or a directory
    #: of part files carrying the same name.
    period_pattern: str = r"yellow_tripdata_(\d{4})-(\d{2})\.parquet(?:/[^/]+)?$"
    period_file_name: str = "yellow_tripdata_%d-%02d.parquet"

    zone_columns: tuple[str, ...] = ("LocationID", "Borough", "Zone", "service_zone")
    #: Text that means "missing" in a delimited dimension file (the public
    #: defaults of pandas.read_csv).
    na_texts: tuple[str, ...] = (
        "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
        "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
        "nan", "null",
    )
    # -------------------------------------------------------------------------

    @property
    def timestamps(self) -> tuple[str, ...]:
        return (self.pickup, self.dropoff)

    @property
    def required(self) -> tuple[str, ...]:
        return self.timestamps + self.ids + self.measures

    @property
    def columns(self) -> tuple[str, ...]:
        return self.required + self.optional_measures

    @property
    def band_labels(self) -> tuple[str, ...]:
        return tuple(label for _, label in self.distance_bands) + (self.no_distance_band,)

    @property
    def passenger_labels(self) -> tuple[str, ...]:
        exact = tuple(str(n) for n in self.exact_passengers)
        return (self.missing_passengers,) + exact + (self.other_passengers,)

    @property
    def passenger_group_labels(self) -> tuple[str, ...]:
        return tuple(label for label, _ in self.passenger_groups)

    @property
    def day_types(self) -> tuple[str, str]:
        return (self.weekday_label, self.weekend_label)


DEFAULT = TripContract()
