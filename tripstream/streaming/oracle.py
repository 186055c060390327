"""DuckDB SQL for the registered streaming queries.

Append-mode results hold only what the final watermark has closed: a
window whose end is at or before max(event time) - delay, or an unmatched
pickup whose match range ended before the join watermark. Slices are cut at
the same whole-hour bounds as in ``tripstream.sinks.slices``.
"""

from __future__ import annotations

from tripstream.plans.oracle import BATCH_ORACLE, QUALITY, RAW, SILVER_CTES, TRIP_SECONDS, TRIP_SIDES, ZONES, _revenue, _volume, _with

EVENTS = "SELECT * FROM events"


def _closed(select_sql: str, delay: str, ts_src: str = "events", ts: str = "ts") -> str:
    return f"""SELECT * FROM ({select_sql}) w
WHERE window_end <= (SELECT max({ts}) FROM {ts_src}) - INTERVAL {delay}"""


def _bound(src: str, ts: str, k: int, n: int) -> str:
    return f"(SELECT (min(epoch_us({ts})) + (max(epoch_us({ts})) - min(epoch_us({ts}))) * {k} // {n}) // 3600000000 * 3600000000 FROM {src})"


def _slice(src: str, ts: str, n: int) -> str:
    return " + ".join(f"coalesce(CAST(epoch_us({ts}) >= {_bound(src, ts, k, n)} AS INTEGER), 0)" for k in range(1, n))


_REV = _revenue("events", "ts", "event_type", "value", "value")

# held: a tenth of the first slice arrives with the last; before that the watermark stands
# at the latest time of the slices but the last, less the delay
HELD = f"""
sliced AS (SELECT *, {_slice('events', 'ts', 4)} AS k FROM events),
marked AS (SELECT *, k = 0 AND event_id % 10 = 3 AS held FROM sliced),
seen AS (SELECT max(ts) AS t FROM marked WHERE k < 3 AND NOT held)"""


def _late(agg_of, delay: str) -> str:
    """A window aggregate in which a held row counts only where its window was still open."""
    window = "time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR"
    return f"""WITH {HELD},
kept AS (SELECT * EXCLUDE (k, held) FROM marked WHERE NOT held OR {window} > (SELECT t FROM seen) - INTERVAL {delay})
{_closed(agg_of('kept'), delay)}"""


LATE_VOLUME = f"""WITH {HELD},
rows_ AS (SELECT time_bucket(INTERVAL 15 MINUTE, ts) - j * INTERVAL 15 MINUTE AS window_start, event_type, held
          FROM marked, (SELECT unnest([0, 1]) AS j) js WHERE ts IS NOT NULL)
SELECT window_start, window_start + INTERVAL 30 MINUTE AS window_end, event_type, count(*) AS trip_volume FROM rows_
WHERE (NOT held OR window_start + INTERVAL 30 MINUTE > (SELECT t FROM seen) - INTERVAL 15 MINUTE)
  AND window_start + INTERVAL 30 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 15 MINUTE
GROUP BY ALL"""

LATE_DEDUP = f"""WITH {HELD}
SELECT * EXCLUDE (k, held) FROM marked WHERE NOT held OR ts > (SELECT t FROM seen) - INTERVAL 10 MINUTE"""

# both sides arrive in the same slices, so the join's watermark is the slower side's
OPEN_TRIPS = f"""{SILVER_CTES}, {TRIP_SIDES},
wm AS (SELECT least((SELECT max(pickup_ts) FROM pk), (SELECT max(dropoff_ts) FROM dk WHERE dropoff_ts IS NOT NULL)) - INTERVAL 30 DAY AS w)
SELECT * FROM pk WHERE pickup_ts IS NULL OR pickup_ts + INTERVAL 30 DAY < (SELECT w FROM wm) AND NOT EXISTS (
  SELECT 1 FROM dk WHERE dk.d_trip_id = pk.trip_id
    AND dropoff_ts >= pickup_ts AND dropoff_ts <= pickup_ts + INTERVAL {TRIP_SECONDS} SECOND)"""

_TIMED = "timed AS (SELECT *, coalesce(tpep_pickup_datetime, tpep_dropoff_datetime) AS t FROM silver)"
# slices are cut over all raw trips
_RAW_TIMED = """raw_timed AS (SELECT coalesce(TRY_CAST(tpep_pickup_datetime AS TIMESTAMP), TRY_CAST(tpep_dropoff_datetime AS TIMESTAMP)) AS t FROM raw)"""


def _raw_slice(n: int) -> str:
    return " + ".join(f"coalesce(CAST(epoch_us(t) >= {_bound('raw_timed', 't', k, n)} AS INTEGER), 0)" for k in range(1, n))


STREAM_ORACLE = {
    "anomaly_rolling_stream": BATCH_ORACLE["anomaly_rolling_hourly"],
    "completed_trips_stream": BATCH_ORACLE["trip_matching"],
    "open_trips_stream": OPEN_TRIPS,
    "bronze_roundtrip": EVENTS,
    "bronze_interval_stream": EVENTS,
    "exactly_once_audit": """
SELECT count(*) AS source_rows, count(*) AS table_rows, CAST(0 AS BIGINT) AS missing_rows, CAST(0 AS BIGINT) AS extra_rows
FROM events""",
    "revenue_hourly_stream": _closed(_REV, "30 MINUTE"),
    # the same result over several triggers (no row is late)
    "revenue_hourly_stream_paced": _closed(_REV, "30 MINUTE"),
    "revenue_late_stream": _late(lambda src: _revenue(src, "ts", "event_type", "value", "value"), "30 MINUTE"),
    "volume_sliding_stream": _closed(_volume("events", "ts", "event_type"), "15 MINUTE"),
    "volume_late_stream": LATE_VOLUME,
    "dedup_stream": EVENTS,
    "dedup_late_stream": LATE_DEDUP,
    "dedup_keyed_stream": EVENTS,
    "dedup_keyed_late_stream": LATE_DEDUP,
    "dedup_then_window_stream": _closed(_REV, "10 MINUTE"),
    "event_matching_stream": """
WITH p AS (SELECT event_id AS pickup_id, ts AS pickup_ts, user_id FROM events WHERE event_id % 2 = 0),
d AS (SELECT event_id AS dropoff_id, ts AS dropoff_ts, user_id AS d_user FROM events WHERE event_id % 2 = 1)
SELECT pickup_id, pickup_ts, user_id, dropoff_id, dropoff_ts,
       (epoch_us(dropoff_ts) - epoch_us(pickup_ts)) / 60000000.0 AS duration_minutes
FROM p JOIN d ON p.user_id = d.d_user
WHERE dropoff_ts >= pickup_ts AND dropoff_ts <= pickup_ts + INTERVAL 10800 SECOND""",
    "event_open_stream": """
WITH p AS (SELECT event_id AS pickup_id, ts AS pickup_ts, user_id FROM events WHERE event_id % 2 = 0),
d AS (SELECT event_id AS dropoff_id, ts AS dropoff_ts, user_id AS d_user FROM events WHERE event_id % 2 = 1),
wm AS (SELECT least((SELECT max(pickup_ts) FROM p), (SELECT max(dropoff_ts) FROM d)) - INTERVAL 3 HOUR AS w)
SELECT * FROM p WHERE NOT EXISTS (
    SELECT 1 FROM d WHERE d.d_user = p.user_id
      AND dropoff_ts >= pickup_ts AND dropoff_ts <= pickup_ts + INTERVAL 10800 SECOND)
  AND pickup_ts + INTERVAL 3 HOUR < (SELECT w FROM wm)""",
    # a third of each slice arrives again with the next; the latest flagging batch wins
    "anomaly_upsert_stream": f"""
WITH sliced AS (SELECT *, {_slice('events', 'ts', 4)} AS k FROM events),
a AS (SELECT *, k AS batch FROM sliced UNION ALL SELECT *, k + 1 AS batch FROM sliced WHERE event_id % 3 = 0 AND k < 3),
s AS (SELECT batch, event_type, avg(value) AS m, stddev_samp(value) AS sd FROM a GROUP BY ALL),
f AS (SELECT a.* FROM a JOIN s ON a.batch = s.batch AND a.event_type = s.event_type WHERE a.value > s.m + s.sd * 2.0)
SELECT event_id, ts, user_id, event_type, value, props, CAST(max(batch) AS BIGINT) AS flagged_hour FROM f GROUP BY ALL""",
    "progress_metrics": f"SELECT count(DISTINCT {_slice('events', 'ts', 4)}) AS triggers, count(*) AS rows_in FROM events",
    "schema_evolution": f"""
SELECT event_id, ts, user_id, event_type, value, CASE WHEN {_slice('events', 'ts', 2)} = 1 THEN props END AS props FROM events""",
    "medallion_silver_stream": BATCH_ORACLE["silver"],
    "medallion_revenue_stream": f"""{SILVER_CTES}, {_TIMED}
{_closed(_revenue('silver', 'tpep_pickup_datetime', 'pickup_borough', 'total_amount', 'fare_amount'), '30 MINUTE', 'silver', 'tpep_pickup_datetime')}""",
    "medallion_volume_stream": f"""{SILVER_CTES}
{_closed(_volume('silver', 'tpep_pickup_datetime', 'pickup_zone'), '15 MINUTE', 'silver', 'tpep_pickup_datetime')}""",
    "gold_partitioned": f"""{SILVER_CTES}
SELECT *, CAST(window_start AS DATE) AS date FROM (
{_closed(_revenue('silver', 'tpep_pickup_datetime', 'pickup_borough', 'total_amount', 'fare_amount'), '30 MINUTE', 'silver', 'tpep_pickup_datetime')}) g""",
    "gold_partitioned_events": f"SELECT *, CAST(window_start AS DATE) AS date FROM ({_closed(_REV, '30 MINUTE')}) g",
    "medallion_anomaly_stream": f"""{SILVER_CTES}, {_TIMED}, {_RAW_TIMED},
b AS (SELECT *, {_raw_slice(3)} AS batch FROM timed),
s AS (SELECT batch, pickup_borough AS pb, avg(fare_amount) AS m, stddev_samp(fare_amount) AS sd FROM b GROUP BY ALL)
SELECT b.* EXCLUDE (t, batch) FROM b JOIN s ON b.batch = s.batch AND b.pickup_borough = s.pb WHERE fare_amount > s.m + s.sd * 2.0""",
    "lookup_refresh_stream": f"""{_with(RAW, ZONES, QUALITY)}, {_RAW_TIMED},
b AS (SELECT z.Borough, coalesce(tpep_pickup_datetime, tpep_dropoff_datetime) AS t FROM quality LEFT JOIN zones z ON PULocationID = z.LocationID)
SELECT CASE WHEN ({_raw_slice(2)}) = 1 THEN Borough || '*' ELSE Borough END AS pickup_borough, count(*) AS trips FROM b GROUP BY ALL""",
}

# the same matches over several triggers (no row is late)
STREAM_ORACLE["event_matching_stream_paced"] = STREAM_ORACLE["event_matching_stream"]
