"""Registered streaming queries.

Each runs Structured Streaming with ``availableNow`` and returns the sink table read back
as a batch DataFrame. One-pass queries read the given Parquet table itself as a file
stream. Event-time queries get their input in a constant number of time slices on one
checkpoint (``sinks.slices``): several triggers and restarts, watermarks that move and
evict state, and no step whose number grows with the rows. The ``*_late`` queries hold a
share of the first slice's rows back until the last, behind the watermark. Work folders
live under the cluster's checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstream.config import DEFAULT_PARAMS
from tripstream.functions.derived import duration_minutes
from tripstream.functions.timestamps import parse_timestamp
from tripstream.operators.dedup import dedup_with_watermark, dedup_within_watermark
from tripstream.operators.matching import SILVER_IDENTITY, interval_join, with_trip_id
from tripstream.operators.windows import revenue_by_window
from tripstream.plans.catalog import TABLE_TRIP_SECONDS, q_silver
from tripstream.schemas import DROPOFF, PICKUP, SILVER_SCHEMA, TRIP_CORE_SCHEMA
from tripstream.session import materialized, work_path
from tripstream.sinks.slices import SLICES, land_in_slices, slice_bounds, slice_number
from tripstream.sinks.tables import clustered, exactly_once_audit, with_date
from tripstream.sinks.upsert import KeyedUpsertTable
from tripstream.sources import bindings as B
from tripstream.sources.streams import JSON_TS_OPTIONS, json_file_stream, table_stream
from tripstream.streaming import layers as L
from tripstream.streaming.runner import (
    ProgressRecorder,
    await_done,
    run_to_table,
    start_foreach_batch,
    start_to_table,
)

P = DEFAULT_PARAMS
EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
CHAIN_SLICES = 3


def _held() -> Column:
    """The rows that the late queries hold back: a tenth of the first hours' events."""
    return F.col("event_id") % 10 == 3


def _schema(spark, d):
    return B.events(spark, d).schema


def _given_events(spark, d) -> DataFrame:
    """The given table itself as a file stream, in one trigger."""
    return table_stream(spark, f"{d.rstrip('/')}/event[s].parquet", _schema(spark, d), "parquet", None)


def _sliced_events(spark, d, build, partition_by=None, held=False, copies: int = 1, fmt: str = "parquet", ckpt=None, on_run=None) -> str:
    """Run ``build(stream)`` into a table over the events in slices; returns the table's path.

    ``on_run(query)`` is called with every finished run.
    """
    land, out, ck = work_path(spark, "landing"), work_path(spark, "table"), ckpt or work_path(spark, "ckpt")
    events, schema = B.events(spark, d), _schema(spark, d)
    if copies > 1:  # every event arrives several times
        events = events.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("_copy")
    early = (slice_number("ts", slice_bounds(events, "ts")) == 0) & _held() if held else None

    def run(_):
        src = json_file_stream(spark, land, schema, None) if fmt == "json" else table_stream(spark, land, schema, "parquet", None)
        q = run_to_table(build(src), out, ck, partition_by=partition_by)
        if on_run:
            on_run(q)

    land_in_slices(events, "ts", land, run, held=early, fmt=fmt)
    return out


def _read_back(spark, path, cols=None):
    df = spark.read.parquet(path)
    return df.select(*cols) if cols else df


def q_bronze_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """SRC-1 + SNK-1: JSON landing -> raw append stream -> Parquet Bronze."""
    return _read_back(spark, _sliced_events(spark, d, lambda s: s, fmt="json"), EVENT_COLS)


def q_bronze_interval_stream(spark, d):
    """STR-11: Bronze on a processing-time trigger, the query left running while a slice lands,
    drained and stopped."""
    land, out, ck, schema = work_path(spark, "landing"), work_path(spark, "bronze"), work_path(spark, "ckpt"), _schema(spark, d)
    running = []

    def run(k):
        if not running:
            running.append(start_to_table(json_file_stream(spark, land, schema, P.table_files_per_trigger), out, ck, trigger="1 second"))
        running[0].processAllAvailable()

    try:
        land_in_slices(B.events(spark, d), "ts", land, run, n=2, fmt="json")
    finally:
        for q in running:
            q.stop()
    return _read_back(spark, out, EVENT_COLS)


def q_exactly_once_audit(spark, d):
    """SNK-12: Bronze written over restarts, the last one finding nothing new, then audited."""
    land, out, ck = work_path(spark, "landing"), work_path(spark, "bronze"), work_path(spark, "ckpt")
    schema = _schema(spark, d)
    run = lambda _: run_to_table(json_file_stream(spark, land, schema, None), out, ck)
    land_in_slices(B.events(spark, d), "ts", land, run, fmt="json")
    run(SLICES)
    return exactly_once_audit(B.events(spark, d), _read_back(spark, out, EVENT_COLS))


def _revenue_events(stream):
    return L.revenue_stream(stream, P, "ts", "event_type", "value", "value")


def _volume_events(stream):
    return L.volume_stream(stream, P, "ts", "event_type")


def q_revenue_hourly_stream(spark, d):
    """STR-2 in one trigger over the given table."""
    out, ck = work_path(spark, "gold"), work_path(spark, "ckpt")
    run_to_table(_revenue_events(_given_events(spark, d)), out, ck)
    return _read_back(spark, out)


def q_revenue_hourly_stream_paced(spark, d):
    """STR-2/8 over several triggers: each window is emitted once the watermark closes it."""
    return _read_back(spark, _sliced_events(spark, d, _revenue_events))


def q_revenue_late_stream(spark, d):
    """STR-9: rows that arrive behind the watermark are left out of their closed windows."""
    return _read_back(spark, _sliced_events(spark, d, _revenue_events, held=True))


def q_volume_sliding_stream(spark, d):
    """STR-3 over several triggers."""
    return _read_back(spark, _sliced_events(spark, d, _volume_events))


def q_volume_late_stream(spark, d):
    """STR-3 + STR-9."""
    return _read_back(spark, _sliced_events(spark, d, _volume_events, held=True))


def _deduped(stream):
    return dedup_within_watermark(L.as_instants(stream, "ts"), "ts", P.silver_watermark)


def _deduped_by_key(stream):
    return dedup_with_watermark(L.as_instants(stream, "ts"), "ts", P.silver_watermark, ["event_id"])


def q_dedup_stream(spark, d):
    """STR-5: every event arrives twice; dedup within a 10 min watermark over all columns."""
    return _read_back(spark, _sliced_events(spark, d, lambda s: L.as_wall_clock(_deduped(s), "ts"), copies=2), EVENT_COLS)


def q_dedup_late_stream(spark, d):
    """STR-5 + STR-9: copies and originals behind the watermark are both left out."""
    return _read_back(spark, _sliced_events(spark, d, lambda s: L.as_wall_clock(_deduped(s), "ts"), copies=2, held=True), EVENT_COLS)


def q_dedup_keyed_stream(spark, d):
    """STR-6: ``dropDuplicates(event_id, ts)`` with a watermark, state purged behind it."""
    return _read_back(spark, _sliced_events(spark, d, lambda s: L.as_wall_clock(_deduped_by_key(s), "ts"), copies=2), EVENT_COLS)


def q_dedup_keyed_late_stream(spark, d):
    """STR-6 + STR-9."""
    return _read_back(spark, _sliced_events(spark, d, lambda s: L.as_wall_clock(_deduped_by_key(s), "ts"), copies=2, held=True), EVENT_COLS)


def q_dedup_then_window_stream(spark, d):
    """STR-10: dedup and the hourly window aggregate chained in one stateful query."""

    def build(s):
        agg = revenue_by_window(_deduped(s), "ts", "event_type", "value", "value", P.revenue_window)
        return L.as_wall_clock(agg, "window_start", "window_end")

    return _read_back(spark, _sliced_events(spark, d, build, copies=2))


def _sides(stream):
    e = stream.select("event_id", "ts", "user_id")
    p = e.filter(F.col("event_id") % 2 == 0).select(F.col("event_id").alias("pickup_id"), F.col("ts").alias("pickup_ts"), "user_id")
    q = e.filter(F.col("event_id") % 2 == 1).select(F.col("event_id").alias("dropoff_id"), F.col("ts").alias("dropoff_ts"), "user_id")
    return (L.as_instants(p, "pickup_ts").withWatermark("pickup_ts", P.completed_watermark),
            L.as_instants(q, "dropoff_ts").withWatermark("dropoff_ts", P.completed_watermark))


def _matched(stream):
    j = interval_join(*_sides(stream), "user_id", "pickup_ts", "dropoff_ts", 0, P.max_trip_seconds)
    return L.as_wall_clock(j, "pickup_ts", "dropoff_ts").withColumn("duration_minutes", duration_minutes("pickup_ts", "dropoff_ts"))


def q_event_matching_stream(spark, d):
    """STR-4 + JON-4 in one trigger: stream-stream interval join with watermarks on both sides."""
    out, ck = work_path(spark, "completed"), work_path(spark, "ckpt")
    run_to_table(_matched(_given_events(spark, d)), out, ck)
    return _read_back(spark, out)


def q_event_matching_stream_paced(spark, d):
    """JON-4 over several triggers: join state is evicted behind the watermark, every match kept."""
    return _read_back(spark, _sliced_events(spark, d, _matched))


def q_event_open_stream(spark, d):
    """JON-6 (stream): pickups with no dropoff, emitted once the watermark passes their range."""

    def build(s):
        j = interval_join(*_sides(s), "user_id", "pickup_ts", "dropoff_ts", 0, P.max_trip_seconds, "leftouter")
        return L.as_wall_clock(j.filter(F.col("dropoff_id").isNull()).select("pickup_id", "pickup_ts", "user_id"), "pickup_ts")

    return _read_back(spark, _sliced_events(spark, d, build))


def q_anomaly_upsert_stream(spark, d):
    """SNK-5..8, JON-5, STR-13, PRJ-7: per-slice statistics and a keyed upsert that really updates.

    A third of each slice's events arrive again with the next slice, so a key can be flagged
    in two batches and the later one replaces the earlier. Afterwards batch 1 is delivered
    again, as after a failure, and an empty batch follows. The clock is fixed (one hour a
    batch), so ``flagged_at`` tells which batch a row is from.
    """
    events = B.events(spark, d)
    schema, bounds = events.schema, slice_bounds(events, "ts")
    k = slice_number("ts", bounds)
    again = (F.col("event_id") % 3 == 0) & (k < SLICES - 1)
    arrives = events.withColumn("_arrives", F.explode(F.when(again, F.array(k, k + 1)).otherwise(F.array(k))))
    land, ck = work_path(spark, "landing"), work_path(spark, "ckpt")
    table = KeyedUpsertTable(spark, work_path(spark, "anomalies"), ["event_id"])
    clock = lambda batch_id: F.timestamp_seconds(F.lit(3600 * batch_id))
    fn = L.anomaly_batch_writer(table, "event_type", "value", 2.0, order=["ts"], clock=clock)
    for i in range(SLICES):
        arrives.filter(F.col("_arrives") == i).drop("_arrives").write.mode("append").parquet(land)
        await_done(start_foreach_batch(table_stream(spark, land, schema, "parquet", None), fn, ck))
    fn(arrives.filter(F.col("_arrives") == 1).drop("_arrives"), 1)
    fn(events.limit(0), SLICES)
    cur = table.read()
    if cur is None:  # nothing was ever flagged
        return events.limit(0).withColumn("flagged_hour", F.lit(0).cast("long"))
    return cur.withColumn("flagged_hour", F.floor(F.unix_seconds("flagged_at") / 3600)).drop("flagged_at")


def q_anomaly_rolling_stream(spark, d):
    """AGG-6 (stream): trailing-24 h per-type statistics from hourly moments over several batches
    cut at whole hours, keyed upsert of flags."""
    events = B.events(spark, d)
    land, ck, schema = work_path(spark, "landing"), work_path(spark, "ckpt"), events.schema
    table = KeyedUpsertTable(spark, work_path(spark, "anomalies"), ["event_id"])
    fn = L.rolling_anomaly_batch_writer(work_path(spark, "moments"), table, "event_type", "ts", "value", P.fare_sigma, 24, ["ts"])
    run = lambda _: await_done(start_foreach_batch(table_stream(spark, land, schema, "parquet", None), fn, ck))
    land_in_slices(events, "ts", land, run)
    cur = table.read()
    return events.limit(0) if cur is None else cur.drop("flagged_at")


def q_progress_metrics(spark, d):
    """SNK-11: progress of a Bronze query over its runs, recorded by a listener into a table.

    Rates and times differ from run to run; what is compared is the triggers that read rows
    and the rows they read.
    """
    land, out, ck, schema = work_path(spark, "landing"), work_path(spark, "bronze"), work_path(spark, "ckpt"), _schema(spark, d)
    rec, ids = ProgressRecorder(), []

    def run(_):
        q = start_to_table(json_file_stream(spark, land, schema, None), out, ck)
        await_done(q)
        rec.wait_terminated(q)
        ids.append(str(q.id))

    spark.streams.addListener(rec)
    try:
        land_in_slices(B.events(spark, d), "ts", land, run, fmt="json")
    finally:
        spark.streams.removeListener(rec)
    path = work_path(spark, "metrics")
    rec.flush(spark, path)
    own = spark.read.parquet(path).filter(F.col("query_id").isin(ids) & (F.col("numInputRows") > 0))
    return own.agg(F.count_distinct("batchId").alias("triggers"), F.sum("numInputRows").alias("rows_in"))


def q_schema_evolution(spark, d):
    """SNK-10: a field appears mid-stream; the same query restarts on its checkpoint and sink
    with the wider schema. Rows from before read back with the field null."""
    events = B.events(spark, d)
    land, out, ck = work_path(spark, "landing"), work_path(spark, "bronze"), work_path(spark, "ckpt")
    late = slice_number("ts", slice_bounds(events, "ts", 2)) == 1
    for part in (events.filter(~late).drop("props"), events.filter(late)):
        part.write.mode("append").options(**JSON_TS_OPTIONS).json(land)
        run_to_table(json_file_stream(spark, land, part.schema, None), out, ck)
    return spark.read.schema(events.schema).parquet(out).select(*EVENT_COLS)


def _timed_trips(spark, d) -> DataFrame:
    """Raw trips with ``_t``, the time they happen at (pickup, else dropoff); stored, as every slice reads them."""
    return materialized(B.raw_trips(spark, d).withColumn("_t", F.coalesce(parse_timestamp(PICKUP), parse_timestamp(DROPOFF))), "trips")


def _medallion(spark, d, after_silver) -> None:
    """JSON landing -> Bronze -> Silver as separate queries joined by storage, slice by slice;
    ``after_silver(path)`` runs whatever reads Silver."""
    land, bronze, silver = (work_path(spark, x) for x in ("landing", "bronze", "silver"))
    ck = [work_path(spark, "ckpt") for _ in range(2)]
    zones = B.zones(spark, d)

    def run(_):
        run_to_table(json_file_stream(spark, land, TRIP_CORE_SCHEMA, None), bronze, ck[0])
        run_to_table(L.silver_stream(table_stream(spark, bronze, TRIP_CORE_SCHEMA, "parquet", None), zones, P), silver, ck[1])
        after_silver(silver)

    trips = _timed_trips(spark, d)
    land_in_slices(trips, "_t", land, run, n=CHAIN_SLICES, fmt="json", columns=[c for c in trips.columns if c != "_t"])


def _gold(spark, d, build, partition_by=None) -> DataFrame:
    out, ck = work_path(spark, "gold"), work_path(spark, "ckpt")

    def run(silver):
        run_to_table(build(table_stream(spark, silver, SILVER_SCHEMA, "parquet", None)), out, ck, partition_by=partition_by)

    _medallion(spark, d, run)
    return _read_back(spark, out)


def q_medallion_silver_stream(spark, d):
    """STR-1, STR-5: Silver as the chain writes it; the same rows as the batch Silver."""
    paths = []
    _medallion(spark, d, paths.append)
    return _read_back(spark, paths[-1])


def q_medallion_revenue_stream(spark, d):
    """The whole chain: JSON landing -> Bronze -> Silver -> Gold A."""
    return _gold(spark, d, lambda s: L.revenue_stream(s, P))


def q_medallion_volume_stream(spark, d):
    """Silver -> Gold B (STR-3 over trips)."""
    return _gold(spark, d, lambda s: L.volume_stream(s, P))


def q_gold_partitioned(spark, d):
    """SNK-9: Gold A laid out by date and borough, read back whole."""
    by = ["date", "pickup_borough"]
    return _gold(spark, d, lambda s: clustered(with_date(L.revenue_stream(s, P)), by), by)


def gold_events_layout(spark, d) -> str:
    """SNK-9 on hourly data: revenue per hour and type, in one directory per date and type."""
    by = ["date", "event_type"]
    return _sliced_events(spark, d, lambda s: clustered(with_date(_revenue_events(s)), by), partition_by=by)


def q_gold_partitioned_events(spark, d):
    return _read_back(spark, gold_events_layout(spark, d))


def q_medallion_anomaly_stream(spark, d):
    """Silver -> fare anomalies per micro-batch (FLT-7, SNK-5/6); 2 deviations, as the tables reach no 3."""
    table, ck = KeyedUpsertTable(spark, work_path(spark, "anomalies"), ["trip_id"]), work_path(spark, "ckpt")
    writer = L.anomaly_batch_writer(table, "pickup_borough", "fare_amount", 2.0, order=[PICKUP])

    def fn(batch, batch_id):
        writer(with_trip_id(batch, SILVER_IDENTITY), batch_id)

    _medallion(spark, d, lambda silver: await_done(start_foreach_batch(table_stream(spark, silver, SILVER_SCHEMA, "parquet", None), fn, ck)))
    return table.read().drop("trip_id", "flagged_at")


def _trips_run(spark, d, how, shape) -> DataFrame:
    """Silver landed in slices and read as two independent streams, pickups joined to dropoffs.

    The shared tables' dates are whole days, so the match window (and both watermarks) is 30
    days here instead of 3 hours.
    """
    silver, out, ck = work_path(spark, "silver"), work_path(spark, "trips"), work_path(spark, "ckpt")
    params = P.with_(max_trip_seconds=TABLE_TRIP_SECONDS, completed_watermark="30 days")

    def run(_):
        two = [table_stream(spark, silver, SILVER_SCHEMA, "parquet", None) for _ in range(2)]
        run_to_table(shape(L.completed_trips_stream(*two, params, how)), out, ck)

    land_in_slices(materialized(q_silver(spark, d), "silver"), PICKUP, silver, run)
    return _read_back(spark, out)


def q_completed_trips_stream(spark, d):
    """SRC-4, PRJ-5/8/9, JON-4, SNK-4."""
    return _trips_run(spark, d, "inner", lambda j: j)


def q_open_trips_stream(spark, d):
    """JON-6 over trips: pickups whose range the watermark has passed without a dropoff."""
    columns = ["trip_id", "pickup_ts", "PULocationID", "pickup_borough"]
    return _trips_run(spark, d, "leftouter", lambda j: j.filter(F.col("dropoff_ts").isNull()).select(*columns))


def q_lookup_refresh_stream(spark, d):
    """STR-14: the zone lookup changes between two micro-batches; each batch is enriched with
    the lookup of its time (here every borough gets a mark before the second batch)."""
    trips = _timed_trips(spark, d)
    land, out, ck = work_path(spark, "landing"), work_path(spark, "silver"), work_path(spark, "ckpt")
    lookups = []
    fn = L.refreshing_enrich_writer(lambda: lookups[-1], out, P)
    zones = B.zones(spark, d)
    late = slice_number("_t", slice_bounds(trips, "_t", 2)) == 1
    for lookup, part in ((zones, trips.filter(~late)), (zones.withColumn("Borough", F.concat("Borough", F.lit("*"))), trips.filter(late))):
        lookups.append(lookup)
        part.drop("_t").write.mode("append").parquet(land)
        stream = table_stream(spark, land, TRIP_CORE_SCHEMA, "parquet", None)
        await_done(start_foreach_batch(stream, lambda b, i: fn(L.apply_quality_filters(b), i), ck))
    return _read_back(spark, out).groupBy("pickup_borough").agg(F.count(F.lit(1)).alias("trips"))


STREAM_QUERIES = {
    "anomaly_rolling_stream": q_anomaly_rolling_stream,
    "completed_trips_stream": q_completed_trips_stream,
    "open_trips_stream": q_open_trips_stream,
    "bronze_roundtrip": q_bronze_roundtrip,
    "bronze_interval_stream": q_bronze_interval_stream,
    "exactly_once_audit": q_exactly_once_audit,
    "revenue_hourly_stream": q_revenue_hourly_stream,
    "revenue_hourly_stream_paced": q_revenue_hourly_stream_paced,
    "revenue_late_stream": q_revenue_late_stream,
    "volume_sliding_stream": q_volume_sliding_stream,
    "volume_late_stream": q_volume_late_stream,
    "gold_partitioned": q_gold_partitioned,
    "gold_partitioned_events": q_gold_partitioned_events,
    "dedup_stream": q_dedup_stream,
    "dedup_late_stream": q_dedup_late_stream,
    "dedup_keyed_stream": q_dedup_keyed_stream,
    "dedup_keyed_late_stream": q_dedup_keyed_late_stream,
    "dedup_then_window_stream": q_dedup_then_window_stream,
    "event_matching_stream": q_event_matching_stream,
    "event_matching_stream_paced": q_event_matching_stream_paced,
    "event_open_stream": q_event_open_stream,
    "anomaly_upsert_stream": q_anomaly_upsert_stream,
    "progress_metrics": q_progress_metrics,
    "schema_evolution": q_schema_evolution,
    "medallion_silver_stream": q_medallion_silver_stream,
    "medallion_revenue_stream": q_medallion_revenue_stream,
    "medallion_volume_stream": q_medallion_volume_stream,
    "medallion_anomaly_stream": q_medallion_anomaly_stream,
    "lookup_refresh_stream": q_lookup_refresh_stream,
}
