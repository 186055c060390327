"""Null matrix for FLT-1..5 and PRJ-1 / PRJ-4 edge cases (three-valued logic)."""

import pytest

from tests.fixtures import row, trips
from tripstream.operators.enrich import add_revenue_per_mile
from tripstream.operators.quality import apply_quality_filters


@pytest.mark.parametrize(
    "changes,kept",
    [
        ({"passenger_count": None}, False),
        ({"fare_amount": None}, False),
        ({"PULocationID": None}, False),
        ({"DOLocationID": None}, False),
        ({"trip_distance": None, "fare_amount": 1.0}, True),  # NOT (null AND false) = true
        ({"trip_distance": None, "fare_amount": 10.0}, False),  # NOT (null AND true) = null
        ({"trip_distance": 0.0, "fare_amount": 2.0}, True),
        ({"trip_distance": 0.0, "fare_amount": 2.01}, False),
        ({"VendorID": None}, True),
        ({"total_amount": None}, True),
    ],
)
def test_null_matrix(spark, changes, kept):
    assert apply_quality_filters(trips(spark, [row(**changes)])).count() == (1 if kept else 0)


def test_malformed_time_is_null_not_error(spark):
    r = apply_quality_filters(trips(spark, [row(tpep_pickup_datetime="bad")])).collect()
    assert len(r) == 1 and r[0]["tpep_pickup_datetime"] is None
    assert str(r[0]["tpep_dropoff_datetime"]) == "2023-01-01 10:30:00"


def test_revenue_per_mile_null_distance(spark):
    df = apply_quality_filters(trips(spark, [row(trip_distance=None, fare_amount=1.0)]))
    assert add_revenue_per_mile(df).first()["revenue_per_mile"] is None
