"""tripmart: batch trip analytics as composable Spark DataFrame functions."""

from tripmart.contract import DEFAULT, TripContract

__all__ = ["DEFAULT", "TripContract"]
