"""foreachBatch writers called directly: replay idempotence (STR-13), rolling moments (AGG-6),
lookup refresh per batch (STR-14)."""

import datetime as dt
import os

from tests.fixtures import ZONE_SCHEMA, row, trips
from tripstream.operators.quality import apply_quality_filters
from tripstream.session import work_path
from tripstream.sinks.upsert import KeyedUpsertTable
from tripstream.sources.tables import read_dimension_csv
from tripstream.streaming.layers import anomaly_batch_writer, refreshing_enrich_writer, rolling_anomaly_batch_writer

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def _events(spark, rows):
    return spark.createDataFrame(rows, "event_id long, event_type string, ts timestamp_ntz, value double")


def _batch0(spark):
    rows = [(i, "A", T0 + dt.timedelta(minutes=i), 10.0) for i in range(20)] + [(99, "A", T0 + dt.timedelta(minutes=30), 500.0)]
    return _events(spark, rows)


def test_anomaly_writer_replay_is_idempotent(spark):
    t = KeyedUpsertTable(spark, work_path(spark, "anom"), ["event_id"])
    fn = anomaly_batch_writer(t, "event_type", "value", order=["ts"])
    fn(_batch0(spark), 0)
    first = sorted((r.event_id, r.value) for r in t.read().collect())
    fn(_batch0(spark), 0)  # the same batch delivered again after a failure
    assert sorted((r.event_id, r.value) for r in t.read().collect()) == first == [(99, 500.0)]
    assert t.versions().count() == 1


def test_rolling_writer_accumulates_and_replays(spark):
    moments = work_path(spark, "moments")
    t = KeyedUpsertTable(spark, work_path(spark, "anom"), ["event_id"])
    fn = rolling_anomaly_batch_writer(moments, t, "event_type", "ts", "value", 3.0, 24, ["ts"])
    fn(_batch0(spark), 0)
    fn(_batch0(spark), 0)  # replay: contribution replaced, not doubled
    m = spark.read.parquet(moments)
    assert m.groupBy().sum("m_n").first()[0] == 21
    # batch 1, an hour later: one fare that is only extreme against the history
    later = _events(spark, [(200, "A", T0 + dt.timedelta(hours=1, minutes=5), 400.0)] + [(201 + i, "A", T0 + dt.timedelta(hours=1, minutes=6 + i), 10.0) for i in range(3)])
    fn(later, 1)
    flagged = sorted(r.event_id for r in t.read().collect())
    assert 99 in flagged
    assert spark.read.parquet(moments).groupBy().sum("m_n").first()[0] == 25


def _zone_csv(d, name):
    with open(os.path.join(d, "zones.csv"), "w") as f:
        f.write(f"LocationID,Borough,Zone,service_zone\n100,{name},Z100,S\n200,{name},Z200,S\n")


def test_lookup_refreshed_between_batches(spark, tmp_path):
    d = str(tmp_path)
    _zone_csv(d, "Old")
    out = work_path(spark, "silver")
    fn = refreshing_enrich_writer(lambda: read_dimension_csv(spark, d, ZONE_SCHEMA), out)
    batch = apply_quality_filters(trips(spark, [row()]))
    fn(batch, 0)
    _zone_csv(d, "New")  # the lookup changes while the stream runs
    fn(batch, 1)
    got = {r.enrich_batch: r.pickup_borough for r in spark.read.parquet(out).collect()}
    assert got == {0: "Old", 1: "New"}


def test_replayed_batch_keeps_its_clock(spark):
    t = KeyedUpsertTable(spark, work_path(spark, "anom"), ["event_id"])
    fn = anomaly_batch_writer(t, "event_type", "value", order=["ts"])
    fn(_batch0(spark), 0)
    first = t.read().first().flagged_at
    fn(_batch0(spark), 0)
    assert t.read().first().flagged_at == first


def test_an_hour_split_over_two_batches_is_not_revisited(spark):
    t = KeyedUpsertTable(spark, work_path(spark, "anom"), ["event_id"])
    fn = rolling_anomaly_batch_writer(work_path(spark, "moments"), t, "event_type", "ts", "value", 2.0, 24, ["ts"])
    fn(_events(spark, [(i, "A", T0 + dt.timedelta(minutes=i), 10.0) for i in range(9)] + [(9, "A", T0 + dt.timedelta(minutes=9), 12.0)]), 0)
    assert [r.event_id for r in t.read().collect()] == [9]
    # later rows of the hour would have raised the threshold; row 9 was judged on what was known
    fn(_events(spark, [(20 + i, "A", T0 + dt.timedelta(minutes=20 + i), 10.0 + 5 * (i % 2)) for i in range(20)]), 1)
    assert 9 in [r.event_id for r in t.read().collect()]
