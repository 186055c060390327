"""DuckDB SQL for ``streaming.catalog_state``."""

from __future__ import annotations

from tripstream.plans.oracle import QUALITY, RAW, ROLLING_HOURLY, SILVER_CTES, TRIP_SIDES, TRIP_SECONDS, _revenue, _volume
from tripstream.streaming.oracle import HELD, _RAW_TIMED, _TIMED, _closed, _raw_slice, _slice

_FREE = lambda k: f"(SELECT min(epoch_us(ts)) + (max(epoch_us(ts)) - min(epoch_us(ts))) * {k} // 4 FROM events)"
# slices cut anywhere, not at whole hours
_FREE_SLICE = " + ".join(f"coalesce(CAST(epoch_us(ts) >= {_FREE(k)} AS INTEGER), 0)" for k in range(1, 4))

_PICK, _DROP = "(SELECT max(ts) FROM events WHERE event_id % 2 = 0)", "(SELECT max(ts) FROM events WHERE event_id % 2 = 1)"
_JOIN_MARK = f"(least({_PICK}, {_DROP}) - INTERVAL 3 HOUR)"

# one pass of the launcher: both slices go through every layer, watermarks end where the last slice left them
_ALL_LAYERS = f"""{SILVER_CTES}, {TRIP_SIDES}, {_TIMED}, {_RAW_TIMED},
rev AS ({_closed(_revenue('silver', 'tpep_pickup_datetime', 'pickup_borough', 'total_amount', 'fare_amount'), '30 MINUTE', 'silver', 'tpep_pickup_datetime')}),
vol AS ({_closed(_volume('silver', 'tpep_pickup_datetime', 'pickup_zone'), '15 MINUTE', 'silver', 'tpep_pickup_datetime')}),
b AS (SELECT *, {_raw_slice(2)} AS batch FROM timed),
s AS (SELECT batch, pickup_borough AS pb, avg(fare_amount) AS m, stddev_samp(fare_amount) AS sd FROM b GROUP BY ALL)
SELECT 'bronze' AS layer, count(*) AS n_rows FROM raw
UNION ALL SELECT 'silver', count(*) FROM silver
UNION ALL SELECT 'gold_revenue', count(*) FROM rev
UNION ALL SELECT 'gold_volume', count(*) FROM vol
UNION ALL SELECT 'completed_trips', count(*) FROM pk JOIN dk ON pk.trip_id = dk.d_trip_id
  WHERE dropoff_ts >= pickup_ts AND dropoff_ts <= pickup_ts + INTERVAL {TRIP_SECONDS} SECOND
UNION ALL SELECT 'anomalies', count(*) FROM b JOIN s ON b.batch = s.batch AND b.pickup_borough = s.pb WHERE fare_amount > s.m + s.sd * 2.0"""

STATE_ORACLE = {
    # rows of hours that the final watermark has closed
    "anomaly_rolling_chain_stream": f"""
SELECT * FROM ({ROLLING_HOURLY}) f
WHERE time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""",
    # every event arrives twice
    "late_rows_dropped": f"""WITH {HELD},
late AS (SELECT CAST(2 * count(*) AS BIGINT) AS dropped_rows FROM marked WHERE held AND ts <= (SELECT t FROM seen) - INTERVAL 10 MINUTE)
SELECT 'within_watermark' AS stream, dropped_rows FROM late UNION ALL SELECT 'with_watermark', dropped_rows FROM late""",
    # the join holds a dropoff once per time bucket that it may serve
    "state_left": f"""
SELECT 'dedup' AS state, count(*) AS keys_left, CAST(0 AS BIGINT) AS behind_watermark FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 20 MINUTE
UNION ALL SELECT 'join_pickups', count(*), 0 FROM events WHERE event_id % 2 = 0 AND ts >= {_JOIN_MARK} - INTERVAL 3 HOUR
UNION ALL SELECT 'join_dropoffs', 2 * count(*), 0 FROM events WHERE event_id % 2 = 1 AND ts >= {_JOIN_MARK}""",
    "bytes_capped_stream": "SELECT count(*) AS rows_in, true AS triggers_follow_bytes FROM events",
    "schema_found": f"SELECT event_id, ts, user_id, event_type, value, CASE WHEN {_slice('events', 'ts', 2)} = 1 THEN props END AS props FROM events",
    # the crash takes one attempt: batches 2 and 3 are flagged an hour later than their number
    "anomaly_recovery_stream": f"""
WITH sliced AS (SELECT *, {_slice('events', 'ts', 4)} AS k FROM events),
a AS (SELECT *, k AS batch FROM sliced UNION ALL SELECT *, k + 1 AS batch FROM sliced WHERE event_id % 3 = 0 AND k < 3),
s AS (SELECT batch, event_type, avg(value) AS m, stddev_samp(value) AS sd FROM a GROUP BY ALL),
f AS (SELECT a.* FROM a JOIN s ON a.batch = s.batch AND a.event_type = s.event_type WHERE a.value > s.m + s.sd * 2.0)
SELECT event_id, ts, user_id, event_type, value, props, CAST(max(CASE WHEN batch > 1 THEN batch + 1 ELSE batch END) AS BIGINT) AS flagged_hour FROM f GROUP BY ALL""",
    "anomaly_threshold_stream": f"""
WITH sliced AS (SELECT *, {_FREE_SLICE} AS k FROM events)
SELECT CAST(n.slice AS BIGINT) AS slice, event_type, quantile_disc(value, 0.99) AS fare_threshold
FROM sliced JOIN (SELECT unnest([0, 1, 2, 3]) AS slice) n ON k <= n.slice WHERE value IS NOT NULL GROUP BY n.slice, event_type""",
    "all_layers_stream": _ALL_LAYERS,
}
