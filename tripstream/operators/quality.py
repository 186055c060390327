"""Quality rules: PRJ-1 and FLT-1..6.

Null handling follows SQL three-valued logic, as the rules are written:
a null passenger count or fare drops the row; a null distance drops the row
only when the fare is above 2 (``NOT (null AND true)`` is null, ``NOT (null
AND false)`` is true).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstream.functions.timestamps import parse_timestamp
from tripstream.schemas import DROPOFF, PICKUP


def parse_trip_times(df: DataFrame, cols=(PICKUP, DROPOFF)) -> DataFrame:
    """PRJ-1: text -> timestamp_ntz in place; malformed text becomes null."""
    for c in cols:
        if dict(df.dtypes).get(c) == "string":
            df = df.withColumn(c, parse_timestamp(c))
    return df


def positive_passengers(col: str = "passenger_count") -> Column:  # FLT-1
    return F.col(col) > 0


def positive_fare(col: str = "fare_amount") -> Column:  # FLT-2
    return F.col(col) > 0


def not_zero_distance_paid(distance: str = "trip_distance", fare: str = "fare_amount", max_fare: float = 2.0) -> Column:  # FLT-3
    return ~((F.col(distance) == 0) & (F.col(fare) > max_fare))


def has_pickup_zone(col: str = "PULocationID") -> Column:  # FLT-4
    return F.col(col).isNotNull()


def has_dropoff_zone(col: str = "DOLocationID") -> Column:  # FLT-5
    return F.col(col).isNotNull()


def quality_predicate() -> Column:
    """FLT-6: conjunction of FLT-1..5."""
    return (
        positive_passengers()
        & positive_fare()
        & not_zero_distance_paid()
        & has_pickup_zone()
        & has_dropoff_zone()
    )


def apply_quality_filters(df: DataFrame) -> DataFrame:
    """PRJ-1 then FLT-6. Plain column predicates, so Catalyst pushes what it can to the scan."""
    return parse_trip_times(df).filter(quality_predicate())
