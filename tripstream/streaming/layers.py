"""The medallion layers as streaming DataFrames.

Each builder takes streaming input and returns a streaming DataFrame; the
runner attaches sink, checkpoint and trigger. The same operators as the
batch plans are used; only event-time handling is stream-specific: the
wall-clock columns are turned into instants for the watermark (Spark
rejects watermarks on ``timestamp_ntz``) and back at the output.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstream.config import DEFAULT_PARAMS, Params
from tripstream.functions.derived import duration_minutes
from tripstream.functions.timestamps import to_instant, to_wall_clock
from tripstream.operators.anomaly import (
    STAT_COLS,
    fare_moments,
    fare_stats,
    flag_against_hourly,
    flag_fare_anomalies,
    hour_index,
    hourly_moments,
    is_outlier,
    moment_stats,
    trailing_hour_stats,
    thresholds_of_counts,
    value_counts,
)
from tripstream.operators.dedup import dedup_within_watermark
from tripstream.operators.enrich import add_revenue_per_mile, enrich_with_zones
from tripstream.operators.matching import dropoff_side, interval_join, pickup_side
from tripstream.operators.quality import apply_quality_filters
from tripstream.operators.windows import revenue_by_window, volume_by_sliding_window
from tripstream.schemas import DROPOFF, PICKUP
from tripstream.session import children
from tripstream.sinks.upsert import KeyedUpsertTable

EVENT_TIME = "_event_time"


def batch_clock(table: KeyedUpsertTable, batch_id: int, now=None) -> Column:
    """PRJ-7: one processing time per micro-batch, as a literal. A batch that was written
    before (a replay after a failure) keeps the time of its first write. ``now``: the clock."""
    before = table.versions(batch_id)
    first = None if before is None else before.agg(F.min("flagged_at").alias("t")).first()["t"]
    now = now or (lambda: _dt.datetime.now(_dt.timezone.utc))
    return F.lit(first or now()).cast("timestamp")


def as_instants(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, to_instant(c))
    return df


def as_wall_clock(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, to_wall_clock(c))
    return df


def silver_stream(bronze: DataFrame, zones: DataFrame, params: Params = DEFAULT_PARAMS, dedup_keys=None) -> DataFrame:
    """Bronze stream -> Silver stream (STR-1, STR-5, JON-1/2 stream-static, PRJ-1..4).

    Order: parse + filter, drop exact copies within the watermark, then enrich (D1: the
    dedup state holds the narrow raw row, not the enriched one). A trip's event time is
    its pickup, or its dropoff where the pickup is unreadable; a trip with neither cannot
    be placed against the watermark and passes as it is.
    """
    clean = apply_quality_filters(bronze).withColumn(EVENT_TIME, F.coalesce(F.col(PICKUP), F.col(DROPOFF)))
    clean = as_instants(clean, EVENT_TIME)
    keys = None if dedup_keys is None else list(dedup_keys)
    timed = dedup_within_watermark(clean.filter(F.col(EVENT_TIME).isNotNull()), EVENT_TIME, params.silver_watermark, keys)
    untimed = clean.filter(F.col(EVENT_TIME).isNull())
    every = timed.drop(EVENT_TIME).unionByName(untimed.drop(EVENT_TIME))
    return add_revenue_per_mile(enrich_with_zones(every, zones))


def revenue_stream(
    silver: DataFrame,
    params: Params = DEFAULT_PARAMS,
    ts: str = PICKUP,
    key: str = "pickup_borough",
    amount: str = "total_amount",
    fare: str = "fare_amount",
) -> DataFrame:
    """Gold A: hourly revenue by borough, emitted once the watermark closes the window (STR-2, STR-8)."""
    s = as_instants(silver, ts).withWatermark(ts, params.revenue_watermark)
    out = revenue_by_window(s, ts, key, amount, fare, params.revenue_window)
    return as_wall_clock(out, "window_start", "window_end")


def volume_stream(silver: DataFrame, params: Params = DEFAULT_PARAMS, ts: str = PICKUP, key: str = "pickup_zone") -> DataFrame:
    """Gold B: 30-minute volume sliding every 15 minutes by zone (STR-3)."""
    s = as_instants(silver, ts).withWatermark(ts, params.volume_watermark)
    out = volume_by_sliding_window(s, ts, key, params.volume_window, params.volume_slide)
    return as_wall_clock(out, "window_start", "window_end")


def completed_trips_stream(
    pickups: DataFrame, dropoffs: DataFrame, params: Params = DEFAULT_PARAMS, how: str = "inner"
) -> DataFrame:
    """Pickups x dropoffs stream-stream interval join (STR-4, JON-4, FLT-8, PRJ-8/9).

    ``pickups`` and ``dropoffs`` are two independent reads of Silver (SRC-4).
    With ``how='leftouter'`` a pickup with no dropoff is emitted (right side
    null) once the watermark passes pickup + max duration (JON-6). A pickup without a time
    matches nothing in either mode; as no watermark can pass it, it is emitted as unmatched
    at once, so that the stream reports what the batch form reports. A dropoff without a time
    matches nothing and is not kept. A trip id holds the pickup time, so a dropoff too far from
    its own pickup matches nothing either: it moves the watermark, but no state keeps it.
    """
    timed, untimed = pickups.filter(F.col(PICKUP).isNotNull()), pickups.filter(F.col(PICKUP).isNull())
    p = as_instants(pickup_side(timed), "pickup_ts").withWatermark("pickup_ts", params.completed_watermark)
    own = dropoff_side(dropoffs.filter(F.col(DROPOFF).isNotNull()), PICKUP)
    d = as_instants(own, "dropoff_ts", PICKUP).withWatermark("dropoff_ts", params.completed_watermark)
    j = interval_join(p, d, "trip_id", "pickup_ts", "dropoff_ts", 0, params.max_trip_seconds, how, right_at=PICKUP)
    j = as_wall_clock(j, "pickup_ts", "dropoff_ts")
    if how == "leftouter":
        j = j.unionByName(pickup_side(untimed), allowMissingColumns=True)
    return j.withColumn("actual_duration_minutes", duration_minutes("pickup_ts", "dropoff_ts"))


def anomaly_batch_writer(
    table: KeyedUpsertTable,
    key: str = "pickup_borough",
    fare: str = "fare_amount",
    sigma: float = DEFAULT_PARAMS.fare_sigma,
    tail: str = "upper",
    order: list[str] | None = None,
    clock=None,
):
    """SNK-5..8 + STR-13: per micro-batch statistics, flag, idempotent keyed upsert.

    The micro-batch is cached once so statistics and the write read the same rows.
    ``clock(batch_id)``: the batch's processing time as a Column (``batch_clock`` by default).
    """

    def fn(batch: DataFrame, batch_id: int) -> None:
        b = batch.persist()
        stats = fare_stats(b, key, fare).persist()  # one row per borough of this batch
        try:
            at = clock(batch_id) if clock else batch_clock(table, batch_id)
            table.upsert(flag_fare_anomalies(b, key, fare, sigma, tail, flagged_at=at, stats=stats), batch_id, order)
        finally:
            stats.unpersist()
            b.unpersist()

    return fn


def rolling_anomaly_batch_writer(
    moments_path: str,
    table: KeyedUpsertTable,
    key: str = "pickup_borough",
    ts: str = PICKUP,
    fare: str = "fare_amount",
    sigma: float = DEFAULT_PARAMS.fare_sigma,
    hours: int = 24,
    order: list[str] | None = None,
):
    """AGG-6 (stream): trailing-24 h statistics from hourly moments kept across micro-batches.

    Batch N writes only its own contribution, into ``moments_batch=N`` (dynamic
    overwrite): a replayed batch replaces its contribution instead of adding it twice. The
    merge reads contributions of batches <= N for the hours the batch can see, which
    parquet statistics narrow down. A row is judged when its batch arrives, on the moments
    known then: an hour that two batches share is judged in the first on its first part and
    is not revisited. Batches cut at whole hours give the batch result.
    """

    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        b = batch.persist()
        try:
            (
                hourly_moments(b, key, ts, fare)
                .withColumn("moments_batch", F.lit(int(batch_id)).cast("long"))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("moments_batch")
                .parquet(moments_path)
            )
            span = b.agg(F.min(hour_index(ts)).alias("lo"), F.max(hour_index(ts)).alias("hi")).first()
            if span["lo"] is None:
                return
            m = spark.read.parquet(moments_path).filter(
                (F.col("moments_batch") <= batch_id) & F.col("hour_idx").between(span["lo"] - (hours - 1), span["hi"])
            )
            stats = trailing_hour_stats(m.drop("moments_batch"), key, hours).persist()
            try:
                flagged = flag_against_hourly(b, stats, key, ts, fare, sigma).withColumn("flagged_at", batch_clock(table, batch_id))
                table.upsert(flagged, batch_id, order)
            finally:
                stats.unpersist()
        finally:
            b.unpersist()

    return fn


def rolling_anomaly_stream(
    rows: DataFrame,
    again: DataFrame,
    key: str = "pickup_borough",
    ts: str = PICKUP,
    fare: str = "fare_amount",
    params: Params = DEFAULT_PARAMS,
    hours: int = 24,
    salts: int = 64,
) -> DataFrame:
    """AGG-6 (stream), right for any cut into batches: rows above their trailing statistics.

    ``again`` is a second read of the same stream. It is summed by hour; the hours that the
    watermark has closed go on into a window of ``hours`` that slides by one hour; a window
    that closes carries the statistics of its last hour, and meets the rows of that hour in a
    stream-stream join. So a row is judged once, on the whole of its hour however the
    batches cut it, and all state (open hours, open windows, waiting rows) is evicted by the
    watermark. Rows wait for the end of their hour as lists, one state entry for each hour, key
    and salt and not several for each row; a hot key's hour is dealt to ``salts`` lists, to each of
    which its statistics (one row an hour) are copied. Rows without time, key or fare are never flagged.
    """

    def timed(df):
        held = df.filter(F.col(ts).isNotNull() & F.col(key).isNotNull() & F.col(fare).isNotNull())
        return held.withColumn(EVENT_TIME, to_instant(ts)).withWatermark(EVENT_TIME, params.anomaly_watermark)

    hourly = timed(again).groupBy(F.window(EVENT_TIME, "1 hour"), F.col(key).alias("_key")).agg(*fare_moments(fare))
    sums = [F.sum(c).cast("decimal(38,0)").alias(c) for c in ("_s1", "_s2")]
    trailing = hourly.groupBy(F.window(F.window_time("window"), f"{hours} hours", "1 hour"), "_key").agg(F.sum("_n").alias("_n"), *sums)
    mean, deviation = moment_stats(F.col("_n"), F.col("_s1"), F.col("_s2"))
    stats = trailing.select(F.window_time("window").alias("_hour"), "_key", mean.alias(STAT_COLS[0]), deviation.alias(STAT_COLS[1]),
                            F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int").alias("_salt_of")
    waiting = (
        timed(rows).groupBy(F.window(EVENT_TIME, "1 hour"), F.col(key).alias("_key_of"), salt).agg(F.collect_list(F.struct(*rows.columns)).alias("_rows"))
        .select(F.window_time("window").alias("_hour_of"), "_key_of", "_salt_of", "_rows")
    )
    at = (F.col("_key_of") == F.col("_key")) & (F.col("_hour_of") == F.col("_hour")) & (F.col("_salt_of") == F.col("_salt"))
    above = F.filter("_rows", lambda x: is_outlier(x[fare], F.col(STAT_COLS[0]), F.col(STAT_COLS[1]), params.fare_sigma, "upper"))
    return waiting.join(stats, at).select(F.explode(above).alias("_row")).select("_row.*")


def threshold_batch_writer(counts_path: str, thresholds_path: str, key: str = "pickup_borough", fare: str = "fare_amount", q: float = 0.99):
    """AGG-7 (stream): exact thresholds over all batches so far, after every batch.

    A batch adds how often it saw each (key, fare) as ``counts_batch=N`` and, from the counts
    of batches up to N, writes the thresholds as ``thresholds_batch=N``: both are replaced when
    the batch is delivered again. The counts are mergeable, so the cut into batches cannot
    move a threshold.
    """

    def fn(batch: DataFrame, batch_id: int) -> None:
        def put(df, name, path):
            w = df.withColumn(name, F.lit(int(batch_id)).cast("long")).write.mode("overwrite")
            w.option("partitionOverwriteMode", "dynamic").partitionBy(name).parquet(path)

        spark = batch.sparkSession
        put(value_counts(batch, key, fare), "counts_batch", counts_path)
        if not any(f.isDirectory() for f in children(spark, counts_path)):
            return  # no fare yet
        so_far = spark.read.parquet(counts_path).filter(F.col("counts_batch") <= batch_id)
        merged = so_far.groupBy(key, "fare_threshold").agg(F.sum("_c").alias("_c"))
        put(thresholds_of_counts(merged, key, q), "thresholds_batch", thresholds_path)

    return fn


def refreshing_enrich_writer(load_zones, path: str, params: Params = DEFAULT_PARAMS):
    """STR-14: a stream-static join whose static side is re-read every micro-batch.

    A plain stream-static join fixes the lookup for the life of the query;
    inside ``foreachBatch`` the lookup is loaded anew for each batch, so an
    updated zone file takes effect from the next batch without a restart.
    Output lands in ``enrich_batch=<id>`` (dynamic overwrite: replay-safe).
    """

    def fn(batch: DataFrame, batch_id: int) -> None:
        enriched = add_revenue_per_mile(enrich_with_zones(batch, load_zones()))
        (
            enriched.withColumn("enrich_batch", F.lit(int(batch_id)).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("enrich_batch")
            .parquet(path)
        )

    return fn
