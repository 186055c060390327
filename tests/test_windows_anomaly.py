"""Window edges (WIN-1/2), anomaly flags (FLT-7, JON-3), rolling stats vs brute force (WIN-3)."""

import datetime as dt
import random

from tripstream.operators.anomaly import fare_thresholds, flag_fare_anomalies, rolling_fare_stats
from tripstream.operators.windows import revenue_by_window, volume_by_sliding_window

EDGES = ["10:00:00", "10:14:59", "10:15:00", "10:59:59", "11:00:00"]


def _edge_df(spark):
    rows = [(dt.datetime.fromisoformat(f"2024-01-01 {t}"), "A", 1.0) for t in EDGES]
    return spark.createDataFrame(rows, "ts timestamp_ntz, k string, v double")


def test_tumbling_edges(spark):
    out = revenue_by_window(_edge_df(spark), "ts", "k", "v", "v", "1 hour").orderBy("window_start").collect()
    assert [(str(r.window_start), r.trip_count) for r in out] == [("2024-01-01 10:00:00", 4), ("2024-01-01 11:00:00", 1)]


def test_sliding_edges_each_row_in_two_windows(spark):
    out = volume_by_sliding_window(_edge_df(spark), "ts", "k", "30 minutes", "15 minutes")
    got = {str(r.window_start)[11:16]: r.trip_volume for r in out.collect()}
    assert got == {"09:45": 2, "10:00": 3, "10:15": 1, "10:30": 1, "10:45": 2, "11:00": 1}
    assert sum(got.values()) == 2 * len(EDGES)


def _fares(spark):
    rows = [("A", 10.0)] * 11 + [("A", 1000.0)]  # n=12: one extreme fare is > 3 sigma
    rows += [("B", 50.0)]  # single trip: stddev null, never flagged
    rows += [(None, 10.0)] * 5 + [(None, 5000.0)]  # null borough: never matches its stats
    rows += [("C", 7.0)] * 20  # sigma = 0, nothing is strictly above the mean
    return spark.createDataFrame(rows, "pickup_borough string, fare_amount double")


def test_fare_outlier_flags(spark):
    out = flag_fare_anomalies(_fares(spark)).collect()
    assert [(r.pickup_borough, r.fare_amount) for r in out] == [("A", 1000.0)]
    assert out[0].flagged_at is not None


def test_both_tails(spark):
    rows = [("A", 100.0)] * 11 + [("A", -1000.0)]
    df = spark.createDataFrame(rows, "pickup_borough string, fare_amount double")
    assert flag_fare_anomalies(df).count() == 0
    assert flag_fare_anomalies(df, tail="both").count() == 1


def test_percentile_threshold(spark):
    df = spark.createDataFrame([("A", float(i)) for i in range(1, 101)], "k string, f double")
    assert fare_thresholds(df, "k", "f", 0.9).first().fare_threshold == 90.0


import pytest  # noqa: E402


@pytest.mark.parametrize("strategy", ["prefix", "halo"])
def test_rolling_matches_brute_force(spark, strategy):
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(400):
        k = rnd.choice(["A", "A", "A", "B"])  # hot key
        t = base + dt.timedelta(seconds=rnd.randrange(0, 5 * 86400))
        rows.append((i, k, t, float(rnd.randrange(1, 10000)) / 100))
    rows.append((400, "A", rows[0][2], 3.0))  # a tie on the order key
    rows += [(500 + i, "A", base + dt.timedelta(days=2), float(i)) for i in range(60)]  # hot (key, time) point
    rows.append((600, "A", base + dt.timedelta(days=3), 7.0))  # exactly 24 h after the hot point
    df = spark.createDataFrame(rows, "id long, k string, ts timestamp_ntz, v double")
    got = {r.id: (r.roll_n, r.roll_avg, r.roll_std) for r in rolling_fare_stats(df, "k", "ts", "v", 86400, strategy).collect()}
    for i, k, t, _ in rows:
        frame = [v for (_, k2, t2, v) in rows if k2 == k and t - dt.timedelta(days=1) <= t2 <= t]
        n, avg, std = got[i]
        assert n == len(frame)
        mean = sum(frame) / len(frame)
        assert abs(avg - mean) < 1e-9
        if len(frame) > 1:
            var = sum((x - mean) ** 2 for x in frame) / (len(frame) - 1)
            assert abs(std - var ** 0.5) < 1e-6
        else:
            assert std is None


def test_percentile_is_exact_over_many_values_ranges_and_nulls(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("AAAB"), round(rnd.random() * 1e6, 2)) for _ in range(5000)] + [("A", None), (None, 5.0), ("C", 1.0)]
    df = spark.createDataFrame(rows, "k string, f double")
    got = {r.k: r.fare_threshold for r in fare_thresholds(df, "k", "f", 0.99, parts=7).collect()}
    want = {}
    for k in "ABC":
        v = sorted(x for a, x in rows if a == k and x is not None)
        want[k] = v[max(1, len(v) - int(len(v) - 0.99 * len(v))) - 1]
    assert got == want


def test_heatmap_keeps_repeated_names_and_unknown_zones(spark):
    from tripstream.operators.windows import volume_matrix

    t = dt.datetime(2024, 1, 1, 10)
    trips = [(t, 56, "Corona"), (t, 57, "Corona"), (t, 57, "Corona"), (t, 999, None), (t, None, None)]
    df = spark.createDataFrame(trips, "ts timestamp_ntz, PULocationID int, pickup_zone string")
    vol = volume_by_sliding_window(df, "ts", "PULocationID", "30 minutes", "15 minutes")
    m = volume_matrix(vol, [56, 57, 57])
    assert m.columns[2:] == ["zone_56", "zone_57", "zone_other"]
    assert all((r.zone_56, r.zone_57, r.zone_other) == (1, 2, 2) for r in m.collect()) and m.count() == 2


def test_money_finer_than_its_scale_is_an_error(spark):
    t = dt.datetime(2024, 1, 1, 10)
    df = spark.createDataFrame([(t, "A", 1.005)], "ts timestamp_ntz, k string, v double")
    with pytest.raises(Exception, match="finer than 2 decimals"):
        revenue_by_window(df, "ts", "k", "v", "v", "1 hour").collect()
