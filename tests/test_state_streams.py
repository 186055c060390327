"""State, lateness, admission and recovery: what the stream engine did, against the tables."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tests.fixtures import row, trips
from tripstream.config import DEFAULT_PARAMS
from tripstream.operators.anomaly import fare_thresholds, flag_rolling_hourly
from tripstream.operators.dedup import dedup_first
from tripstream.operators.matching import SILVER_IDENTITY, with_trip_id
from tripstream.operators.quality import apply_quality_filters
from tripstream.session import work_path
from tripstream.sinks.upsert import KeyedUpsertTable
from tripstream.sources.streams import table_stream
from tripstream.sources.tables import read_found
from tripstream.streaming import layers as L
from tripstream.streaming.runner import CrashAfterWrite, await_done, run_to_table, start_foreach_batch
from tripstream.streaming.state import left_in_state, operator_state, state_operators

T0 = dt.datetime(2024, 1, 1)
EVENTS = "event_id long, event_type string, ts timestamp_ntz, value double"


def made_up(seed, n, hours=72):
    rng = random.Random(seed)
    at = sorted(rng.randrange(hours * 3600) for _ in range(n))
    return [(i, rng.choice("AAB"), T0 + dt.timedelta(seconds=t), rng.choice([10.0, 11.5, 9.25, 12.0, 80.0 if rng.random() < 0.2 else 10.5])) for i, t in enumerate(at)]


def run_in_cuts(spark, rows, cuts, build):
    land, out, ck = work_path(spark, "l"), work_path(spark, "o"), work_path(spark, "c")
    schema, seen = spark.createDataFrame([], EVENTS).schema, []
    for a, b in zip([0, *cuts], [*cuts, len(rows)]):
        spark.createDataFrame(rows[a:b], EVENTS).coalesce(1).write.mode("append").parquet(land)
        seen.append(run_to_table(build(lambda: table_stream(spark, land, schema, "parquet", None)), out, ck))
    return spark.read.parquet(out), seen


@pytest.mark.parametrize("cuts", [[], [151, 152, 290]])
def test_rolling_chain_is_the_same_for_any_cut(spark, cuts):
    rows = made_up(1, 400) + [(900, "A", T0 + dt.timedelta(hours=80), 10.0), (901, "B", T0 + dt.timedelta(hours=80), 10.0)]
    params = DEFAULT_PARAMS.with_(fare_sigma=2.0)
    got, seen = run_in_cuts(spark, rows, cuts, lambda read: L.rolling_anomaly_stream(read(), read(), "event_type", "ts", "value", params))
    want = flag_rolling_hourly(spark.createDataFrame(rows, EVENTS), "event_type", "ts", "value", 2.0)
    assert want.count() > 3
    assert sorted(r.event_id for r in got.collect()) == sorted(r.event_id for r in want.collect())
    ends = [p for q in seen for p in q.recentProgress][-1]
    assert all(o.numRowsTotal < 60 for o in ends.stateOperators)  # open hours and windows, not the history


def test_rolling_chain_state_holds_lists_of_rows(spark):
    rows = made_up(5, 1_500) + [(9_000, "A", T0 + dt.timedelta(hours=80), 10.0), (9_001, "B", T0 + dt.timedelta(hours=80), 10.0)]
    got, seen = run_in_cuts(spark, rows, [700], lambda read: L.rolling_anomaly_stream(read(), read(), "event_type", "ts", "value", DEFAULT_PARAMS.with_(fare_sigma=2.0), salts=1))
    want = flag_rolling_hourly(spark.createDataFrame(rows, EVENTS), "event_type", "ts", "value", 2.0)
    assert sorted(r.event_id for r in got.collect()) == sorted(r.event_id for r in want.collect())
    held = max(o.numRowsTotal for q in seen for p in q.recentProgress for o in p.stateOperators)
    assert held < 400, held  # 72 hours of two keys and windows sliding over them; a row each was over 700


def test_rolling_chain_leaves_out_rows_without_time_key_or_fare(spark):
    rows = made_up(2, 200) + [(900, "A", T0 + dt.timedelta(hours=90), 10.0), (901, None, T0, 999.0), (902, "A", None, 999.0), (903, "A", T0, None)]
    got, _ = run_in_cuts(spark, rows, [], lambda read: L.rolling_anomaly_stream(read(), read(), "event_type", "ts", "value", DEFAULT_PARAMS))
    assert not {r.event_id for r in got.collect()} & {901, 902, 903}


def test_thresholds_after_every_batch_are_the_batch_ones(spark):
    rows = made_up(3, 300)
    counts, out = work_path(spark, "counts"), work_path(spark, "thresholds")
    fn = L.threshold_batch_writer(counts, out, "event_type", "value", 0.9)
    parts = [rows[:100], rows[100:101], rows[101:]]
    for i, part in enumerate(parts):
        fn(spark.createDataFrame(part, EVENTS), i)
    fn(spark.createDataFrame(parts[1], EVENTS), 1)  # delivered again
    for i in range(3):
        want = fare_thresholds(spark.createDataFrame(sum(parts[: i + 1], []), EVENTS), "event_type", "value", 0.9).collect()
        got = spark.read.parquet(out).where(f"thresholds_batch = {i}").select("event_type", "fare_threshold").collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    fn(spark.createDataFrame([], EVENTS), 3)


def test_a_crash_between_write_and_commit_redelivers_the_batch(spark):
    land, ck, schema = work_path(spark, "l"), work_path(spark, "c"), spark.createDataFrame([], EVENTS).schema
    table, times = KeyedUpsertTable(spark, work_path(spark, "t"), ["event_id"]), []

    def clock(batch_id):
        times.append(batch_id)
        return L.batch_clock(table, batch_id, lambda: T0.replace(tzinfo=dt.timezone.utc) + dt.timedelta(hours=len(times)))

    fn = CrashAfterWrite(L.anomaly_batch_writer(table, "event_type", "value", 2.0, order=["ts"], clock=clock), 0)
    spark.createDataFrame([(i, "A", T0, 10.0) for i in range(30)] + [(99, "A", T0, 500.0)], EVENTS).write.parquet(land)
    start = lambda: await_done(start_foreach_batch(table_stream(spark, land, schema, "parquet", None), fn, ck))
    with pytest.raises(StreamingQueryException):
        start()
    first = table.read().collect()
    start()
    assert times == [0, 0] and table.read().collect() == first and [r.event_id for r in first] == [99]
    start()  # nothing new: the batch is committed now
    assert times == [0, 0]


def test_state_source_shows_what_the_watermark_leaves(spark):
    rows = made_up(4, 200)
    ck = work_path(spark, "ck")
    land, out = work_path(spark, "l"), work_path(spark, "o")
    spark.createDataFrame(rows, EVENTS).write.parquet(land)
    build = lambda: L.as_wall_clock(L.dedup_within_watermark(L.as_instants(table_stream(spark, land, None, "parquet", None), "ts"), "ts", "10 minutes"), "ts")
    run_to_table(build(), out, ck)
    state = operator_state(spark, ck)
    last = max(r[2] for r in rows)
    left = left_in_state(state, F.timestamp_micros("value.expiresAtMicros"), F.lit(last.replace(tzinfo=dt.timezone.utc)) - F.expr("INTERVAL 10 MINUTES")).first()
    assert left.behind_watermark == 0 and left.keys_left == sum(r[2] > last - dt.timedelta(minutes=20) for r in rows)
    assert [r.operatorName for r in state_operators(spark, ck).collect()] == ["dedupeWithinWatermark"]


def test_bytes_cap_takes_several_small_files_at_a_time(spark):
    land = work_path(spark, "l")
    spark.range(4000).repartition(16).write.parquet(land)
    size = sum(os.path.getsize(os.path.join(land.replace("file:", ""), f)) for f in os.listdir(land.replace("file:", "")) if f.endswith(".parquet"))
    q = run_to_table(table_stream(spark, land, max_bytes=size // 4 + 1), work_path(spark, "o"), work_path(spark, "c"))
    assert 3 <= sum(json.loads(p.json)["numInputRows"] > 0 for p in q.recentProgress) <= 6


def test_footers_give_new_and_widened_columns(spark):
    p = work_path(spark, "t")
    spark.sql("SELECT 1 AS a, CAST(1.25 AS DECIMAL(5,2)) AS v").write.parquet(p)
    spark.sql("SELECT 2 AS a, CAST(123456789.5 AS DECIMAL(12,2)) AS v, 'x' AS b").write.mode("append").parquet(p)
    got = read_found(spark, p)
    assert dict(got.dtypes) == {"a": "int", "v": "decimal(12,2)", "b": "string"}
    assert sorted((r.a, float(r.v), r.b) for r in got.collect()) == [(1, 1.25, None), (2, 123456789.5, "x")]


def test_null_key_parts_are_never_equal(spark):
    rows = [(1, None, 5.0), (1, None, 6.0), (1, None, 6.0), (1, 2, 5.0), (1, 2, 6.0), (None, None, 7.0)]
    df = spark.createDataFrame(rows, "a int, b int, v double")
    got = sorted(map(tuple, dedup_first(df, ["a", "b"], ["v"]).collect()), key=str)
    assert got == sorted([(1, None, 5.0), (1, None, 6.0), (1, 2, 5.0), (None, None, 7.0)], key=str)


def test_unplaced_pickups_are_open_in_both_forms(spark):
    from tripstream.plans.catalog import match_trips

    raw = trips(spark, [row(tpep_pickup_datetime="?"), row(tpep_pickup_datetime="?", fare_amount=20.0), row(), row(tpep_dropoff_datetime="?", VendorID=2),
                        row(tpep_pickup_datetime="2023-02-01 00:00:00", tpep_dropoff_datetime="2023-02-01 00:10:00", VendorID=3)])
    from tests.fixtures import zones
    from tripstream.plans.layers import silver_batch

    silver = silver_batch(raw, zones(spark, [(100, "A", "Corona", "x"), (200, "B", "Corona", "x")]))
    path, out = work_path(spark, "s"), work_path(spark, "o")
    silver.write.parquet(path)
    two = [table_stream(spark, path, silver.schema, "parquet", None) for _ in range(2)]
    run_to_table(L.completed_trips_stream(*two, how="leftouter").filter(F.col("dropoff_ts").isNull()), out, work_path(spark, "c"))
    cols = ["trip_id", "pickup_ts", "PULocationID", "pickup_borough"]
    stream = sorted(map(str, spark.read.parquet(out).select(*cols).collect()))
    batch = sorted(map(str, match_trips(silver, DEFAULT_PARAMS.max_trip_seconds, "left_anti").select(*cols).collect()))
    assert stream == batch and len(batch) == 3


def test_launcher_and_query_share_one_identity(spark):
    quality = apply_quality_filters(trips(spark, [row(), row(fare_amount=13.0), row(tpep_pickup_datetime="?"), row(tpep_pickup_datetime="?", tip_amount=1.0)]))
    ids = with_trip_id(quality, SILVER_IDENTITY).select("trip_id").distinct().count()
    assert ids == 4
    import inspect

    from tripstream.streaming import pipeline

    assert "with_trip_id(batch, SILVER_IDENTITY)" in inspect.getsource(pipeline)
