"""Category labels.

No label is ever null.  Beyond convenience this keeps plans lean: joining on a
nullable derived key makes the optimizer push ``key IS NOT NULL`` with the whole
expression down into the scan filter.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripmart.contract import DEFAULT, TripContract


def distance_band(distance: Column, contract: TripContract = DEFAULT) -> Column:
    """Half-open bands; null and non-positive distances get their own label."""
    (floor, floor_label), *upper = contract.distance_bands
    label = F
    for bound, name in reversed(upper):
        label = label.when(distance >= F.lit(bound), name)
    return label.when(distance > F.lit(floor), floor_label).otherwise(contract.no_distance_band)


def passenger_category(passengers: Column, contract: TripContract = DEFAULT) -> Column:
    """Exact counts keep their number; any other present value is the last label.

    Negative and fractional counts therefore land in the last label too.
    """
    exact = passengers.isin([float(n) for n in contract.exact_passengers])
    number = F.when(exact, passengers.try_cast("int").cast("string"))
    present = F.coalesce(number, F.lit(contract.other_passengers))
    return F.when(passengers.isNull(), contract.missing_passengers).otherwise(present)


def passenger_group(category: Column, contract: TripContract = DEFAULT) -> Column:
    """Label of the group a passenger category belongs to, else an empty text."""
    group = F
    for label, members in contract.passenger_groups:
        group = group.when(category.isin(list(members)), label)
    return group.otherwise("")


def day_type(weekend: Column, contract: TripContract = DEFAULT) -> Column:
    return F.when(weekend, contract.weekend_label).otherwise(contract.weekday_label)


def ordinal(label: Column, domain) -> Column:
    """Position of a label in its domain, for sorting reports."""
    return F.array_position(F.array(*[F.lit(name) for name in domain]), label)
