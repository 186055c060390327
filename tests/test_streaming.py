"""Streaming: ordered vs out-of-order landing, late rows, stream <-> batch equality."""

import json
import os
import time

from pyspark.sql import functions as F

import __spark_entry__ as E
from tripstream.config import DEFAULT_PARAMS
from tripstream.session import work_path
from tripstream.sources.streams import json_file_stream
from tripstream.streaming import layers as L
from tripstream.streaming.runner import await_done, start_to_table

SCHEMA = "ts timestamp_ntz, event_type string, value double"


def _land(tmp_path, rows_per_file, mtimes):
    d = str(tmp_path)
    now = time.time()
    for i, rows in enumerate(rows_per_file):
        p = os.path.join(d, f"batch_{i:05d}.json")
        with open(p, "w") as f:
            for ts, v in rows:
                f.write(json.dumps({"ts": f"2024-01-01T{ts}.000000", "event_type": "A", "value": v}) + "\n")
        os.utime(p, (now - 100 + mtimes[i], now - 100 + mtimes[i]))
    return d


FILES = [
    [("10:00:00", 1.0), ("10:20:00", 2.0)],
    [("10:30:00", 4.0), ("11:50:00", 8.0)],
    # 10:05 is behind the watermark (11:20) but its window is only evicted at the
    # end of this batch: rows are judged late against the previous batch's watermark
    [("10:05:00", 16.0), ("12:40:00", 32.0)],
    [("10:10:00", 64.0), ("12:45:00", 128.0)],  # window 10:00 is gone: 64.0 is dropped
]


def _run(spark, landing, max_files):
    s = json_file_stream(spark, landing, spark.createDataFrame([], SCHEMA).schema, max_files)
    out, ck = work_path(spark, "gold"), work_path(spark, "ck")
    q = await_done(start_to_table(L.revenue_stream(s, DEFAULT_PARAMS, "ts", "event_type", "value", "value"), out, ck))
    res = {str(r.window_start)[11:16]: r.revenue_in_window for r in spark.read.parquet(out).collect()}
    dropped = sum(
        (p.get("stateOperators") or [{}])[0].get("numRowsDroppedByWatermark", 0)
        for p in [json.loads(x.json) if hasattr(x, "json") else x for x in q.recentProgress]
    )
    return res, dropped


def test_late_row_dropped_in_order(spark, tmp_path):
    res, dropped = _run(spark, _land(tmp_path, FILES, [1, 2, 3, 4]), 1)
    assert res == {"10:00": 23.0, "11:00": 8.0}  # 12:00 is still open at the final watermark
    assert dropped == 1


def test_single_trigger_has_no_late_rows(spark, tmp_path):
    res, dropped = _run(spark, _land(tmp_path, FILES, [1, 2, 3, 4]), None)
    assert res == {"10:00": 87.0, "11:00": 8.0}
    assert dropped == 0


def test_out_of_order_files_drop_rows(spark, tmp_path):
    # same files published newest first: the early rows arrive after the watermark moved
    res, dropped = _run(spark, _land(tmp_path, FILES, [4, 3, 2, 1]), 1)
    assert res == {"10:00": 80.0}  # 64 + 16 made it; the on-time rows of files 1-2 were late
    assert dropped > 0


def test_stream_equals_batch_on_closed_windows(spark, sf_small):
    stream = E.queries()["revenue_hourly_stream"](spark, sf_small)
    batch = E.queries()["revenue_hourly_events"](spark, sf_small)
    wm = spark.read.parquet(f"{sf_small}/events.parquet").agg(F.max("ts")).first()[0]
    import datetime as dt

    closed = batch.filter(F.col("window_end") <= F.lit(wm - dt.timedelta(minutes=30)))
    assert stream.exceptAll(closed).count() == 0 and closed.exceptAll(stream).count() == 0


def test_stream_join_multi_trigger_evicts_state(spark, sf_small, monkeypatch):
    """Slices on one checkpoint: every match is found, and the range in the join condition
    lets the watermark evict old pickups."""
    from tripstream.streaming import catalog as C

    seen = []
    run = C.run_to_table
    monkeypatch.setattr(C, "run_to_table", lambda *a, **k: seen.append(run(*a, **k)))
    got = sorted((r.pickup_id, r.dropoff_id) for r in C.q_event_matching_stream_paced(spark, sf_small).collect())
    want = sorted((r.pickup_id, r.dropoff_id) for r in E.queries()["event_matching"](spark, sf_small).collect())
    assert got == want
    progress = [json.loads(x.json) for q in seen for x in q.recentProgress]
    assert len(seen) == C.SLICES and sum(p["numInputRows"] > 0 for p in progress) == C.SLICES
    rows = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p.get("stateOperators")]
    assert rows[-1] < max(rows) / 2  # what the watermark has passed is gone


def test_late_rows_are_dropped_by_the_watermark(spark, sf_small, monkeypatch):
    from tripstream.streaming import catalog as C

    seen = []
    run = C.run_to_table
    monkeypatch.setattr(C, "run_to_table", lambda *a, **k: seen.append(run(*a, **k)))
    late = C.q_revenue_late_stream(spark, sf_small)
    dropped = sum(op.numRowsDroppedByWatermark for q in seen for p in q.recentProgress for op in p.stateOperators)
    every = C.q_revenue_hourly_stream(spark, sf_small)
    assert dropped > 0 and every.groupBy().sum("trip_count").first()[0] > late.groupBy().sum("trip_count").first()[0]


def test_progress_recorder_waits_no_longer_than_told(spark):
    import types

    import pytest

    from tripstream.streaming.runner import ProgressRecorder

    with pytest.raises(TimeoutError):
        ProgressRecorder().wait_terminated(types.SimpleNamespace(runId="x", name="x", id="x"), 0.05)


def test_unreadable_pickups_stay_distinct_in_batch_and_stream(spark):
    from tests.fixtures import row, trips, zones
    from tripstream.plans.layers import silver_batch
    from tripstream.schemas import TRIP_CORE_SCHEMA
    from tripstream.sources.streams import table_stream
    from tripstream.streaming.runner import run_to_table

    bad = [row(tpep_pickup_datetime="?"), row(tpep_pickup_datetime="?", fare_amount=20.0), row(tpep_pickup_datetime="?"),
           row(tpep_pickup_datetime="?", tpep_dropoff_datetime="?"), row(), row()]
    raw, z = trips(spark, bad), zones(spark, [(100, "A", "Corona", "x"), (200, "B", "Corona", "x")])
    path, out = work_path(spark, "bronze"), work_path(spark, "silver")
    raw.write.parquet(path)
    stream = L.silver_stream(table_stream(spark, path, TRIP_CORE_SCHEMA, "parquet", None), z)
    run_to_table(stream, out, work_path(spark, "ck"))
    batch = sorted(map(str, silver_batch(raw, z).collect()))
    assert len(batch) == 4 and batch == sorted(map(str, spark.read.parquet(out).collect()))


def test_progress_metrics_counts_triggers_and_rows(spark, sf_small):
    r = E.queries()["progress_metrics"](spark, sf_small).first()
    assert (r.triggers, r.rows_in) == (4, spark.read.parquet(f"{sf_small}/events.parquet").count())
