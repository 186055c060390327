"""The reference's Silver unit cases, plus real trip-id tests where it has stubs."""

from tests.fixtures import V, row, trips, zones
from tripstream.operators.enrich import add_revenue_per_mile, enrich_with_zones
from tripstream.functions.ids import trip_id
from tripstream.operators.matching import TRIP_KEY, with_trip_id
from tripstream.operators.quality import apply_quality_filters, parse_trip_times


def test_negative_and_zero_fares_dropped(spark):
    df = trips(spark, [row(fare_amount=-5.0, total_amount=0.0), row(fare_amount=0.0, total_amount=0.0), V])
    out = apply_quality_filters(df)
    assert out.count() == 1
    assert out.first()["fare_amount"] == 12.0


def test_zero_distance_paid_trips_dropped(spark):
    df = trips(
        spark,
        [
            row(trip_distance=0.0, fare_amount=10.0, total_amount=12.0),
            row(trip_distance=0.0, fare_amount=1.0, tip_amount=0.0, total_amount=1.0),
            V,
        ],
    )
    rows = apply_quality_filters(df).collect()
    assert len(rows) == 2
    assert all(r["fare_amount"] <= 2 for r in rows if r["trip_distance"] == 0.0)


def test_null_and_zero_passengers_dropped(spark):
    out = apply_quality_filters(trips(spark, [row(passenger_count=None), row(passenger_count=0), V]))
    assert out.count() == 1
    assert out.first()["passenger_count"] == 2


def test_valid_row_passes(spark):
    r = apply_quality_filters(trips(spark, [V])).collect()
    assert len(r) == 1
    assert (r[0]["fare_amount"], r[0]["passenger_count"], r[0]["trip_distance"]) == (12.0, 2, 3.5)


def test_zones_resolved(spark):
    z = zones(spark, [(100, "Manhattan", "Upper East Side N", "Yellow Zone"), (200, "Brooklyn", "Bay Ridge", "Boro Zone")])
    r = enrich_with_zones(apply_quality_filters(trips(spark, [V])), z).first()
    assert (r["pickup_borough"], r["pickup_zone"]) == ("Manhattan", "Upper East Side N")
    assert (r["dropoff_borough"], r["dropoff_zone"]) == ("Brooklyn", "Bay Ridge")


def test_unknown_zone_gives_null(spark):
    z = zones(spark, [(100, "Manhattan", "Upper East Side N", "Yellow Zone")])
    r = enrich_with_zones(apply_quality_filters(trips(spark, [row(PULocationID=999, DOLocationID=888)])), z).collect()
    assert len(r) == 1
    assert r[0]["pickup_borough"] is None and r[0]["dropoff_borough"] is None


def test_revenue_per_mile(spark):
    r = add_revenue_per_mile(apply_quality_filters(trips(spark, [V]))).first()
    assert abs(r["revenue_per_mile"] - 15.0 / 3.5) < 1e-6


def test_revenue_per_mile_zero_distance_is_null(spark):
    df = trips(spark, [row(trip_distance=0.0, fare_amount=1.0, tip_amount=0.0, total_amount=1.0)])
    assert add_revenue_per_mile(apply_quality_filters(df)).first()["revenue_per_mile"] is None


def _ids(spark, rows):
    df = parse_trip_times(trips(spark, rows))
    return [r["trip_id"] for r in with_trip_id(df).collect()]


def test_trip_id_deterministic(spark):
    a = _ids(spark, [V, V])
    assert a[0] == a[1] and len(a[0]) == 32
    assert _ids(spark, [V]) == a[:1]


def test_trip_ids_differ(spark):
    ids = _ids(spark, [V, row(VendorID=2), row(tpep_pickup_datetime="2023-01-01 10:00:01"), row(PULocationID=101)])
    assert len(set(ids)) == 4


def test_trip_id_null_field_does_not_collide(spark):
    # concat_ws skips nulls: without a null marker (1, null, 100) would equal (1, 100)
    ids = _ids(spark, [row(tpep_pickup_datetime=None), V])
    assert ids[0] != ids[1]
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    assert with_trip_id(df, ("x", "y", "z")).select("trip_id").distinct().count() == 2


def test_trip_id_murmur3_is_32_bit(spark):
    df = parse_trip_times(trips(spark, [V, row(VendorID=2)]))
    ids = [r["trip_id"] for r in with_trip_id_algo(df, "murmur3").collect()]
    assert all(isinstance(i, int) and -(2**31) <= i < 2**31 for i in ids) and ids[0] != ids[1]


def test_trip_id_ignores_non_key_fields(spark):
    ids = _ids(spark, [V, row(fare_amount=99.0, DOLocationID=7)])
    assert ids[0] == ids[1]


def with_trip_id_algo(df, algo):
    return df.withColumn("trip_id", trip_id(df, list(TRIP_KEY), algo))
