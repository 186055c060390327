"""Independent SQL for each registered query, runnable by DuckDB on the shared tables.

Written from the operators' stated semantics, not generated from Spark plans.
The damage rules of ``raw_trips`` are the fixed values listed in
``tripstream.sources.bindings``.
"""

from __future__ import annotations

RAW = """
raw AS (
  SELECT CAST(l_suppkey AS INTEGER) AS VendorID,
    CASE WHEN l_orderkey % 37 = 0 THEN 'not a time'
         ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS tpep_pickup_datetime,
    strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS tpep_dropoff_datetime,
    CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE l_linenumber - 1 END AS passenger_count,
    CASE WHEN l_partkey % 11 = 0 THEN CAST(0.0 AS DOUBLE) ELSE l_quantity END AS trip_distance,
    CASE WHEN l_orderkey % 19 = 0 THEN NULL WHEN l_orderkey % 23 = 0 THEN 99 ELSE c_nationkey END AS PULocationID,
    CASE WHEN l_partkey % 29 = 0 THEN NULL ELSE s_nationkey END AS DOLocationID,
    CASE WHEN l_suppkey % 2 = 0 THEN l_extendedprice - 2000 ELSE CAST(1.5 AS DOUBLE) END AS fare_amount,
    ((CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(round(l_discount * 100) AS BIGINT) + 50) // 100) / 100.0 AS tip_amount,
    ((CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT))
       * (100 + CAST(round(l_tax * 100) AS BIGINT)) + 5000) // 10000) / 100.0 AS total_amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey
)"""

ZONES = """
zones AS (
  SELECT n_nationkey AS LocationID, r_name AS Borough, n_name AS Zone, r_name AS service_zone
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
)"""

QUALITY = """
parsed AS (
  SELECT VendorID,
    TRY_CAST(tpep_pickup_datetime AS TIMESTAMP) AS tpep_pickup_datetime,
    TRY_CAST(tpep_dropoff_datetime AS TIMESTAMP) AS tpep_dropoff_datetime,
    passenger_count, trip_distance, PULocationID, DOLocationID, fare_amount, tip_amount, total_amount
  FROM raw
),
quality AS (
  SELECT * FROM parsed
  WHERE passenger_count > 0 AND fare_amount > 0
    AND NOT (trip_distance = 0 AND fare_amount > 2)
    AND PULocationID IS NOT NULL AND DOLocationID IS NOT NULL
)"""

DEDUP = """
dedup AS (
  SELECT VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance,
         PULocationID, DOLocationID, fare_amount, tip_amount, total_amount
  FROM (
    SELECT *, row_number() OVER (
      PARTITION BY VendorID, tpep_pickup_datetime, PULocationID
      ORDER BY tpep_pickup_datetime NULLS FIRST, tpep_dropoff_datetime NULLS FIRST,
               passenger_count NULLS FIRST, trip_distance NULLS FIRST, DOLocationID NULLS FIRST,
               fare_amount NULLS FIRST, tip_amount NULLS FIRST, total_amount NULLS FIRST) AS rn
    FROM quality
    WHERE VendorID IS NOT NULL AND tpep_pickup_datetime IS NOT NULL AND PULocationID IS NOT NULL) t
  WHERE rn = 1
  UNION ALL
  SELECT DISTINCT VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance,
         PULocationID, DOLocationID, fare_amount, tip_amount, total_amount
  FROM quality WHERE VendorID IS NULL OR tpep_pickup_datetime IS NULL OR PULocationID IS NULL
)"""


def _enriched(src: str) -> str:
    return f"""
SELECT q.VendorID, q.tpep_pickup_datetime, q.tpep_dropoff_datetime, q.passenger_count, q.trip_distance,
       q.PULocationID, q.DOLocationID, pz.Borough AS pickup_borough, pz.Zone AS pickup_zone,
       dz.Borough AS dropoff_borough, dz.Zone AS dropoff_zone, q.fare_amount, q.tip_amount, q.total_amount
FROM {src} q
LEFT JOIN zones pz ON q.PULocationID = pz.LocationID
LEFT JOIN zones dz ON q.DOLocationID = dz.LocationID"""


SILVER = f"""
silver AS (
  SELECT *, CASE WHEN trip_distance <> 0 THEN total_amount / trip_distance END AS revenue_per_mile
  FROM ({_enriched('(SELECT DISTINCT * FROM quality)')}) e
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


SILVER_CTES = _with(RAW, ZONES, QUALITY, SILVER)

TRIP_SECONDS = 30 * 86400
EVENT_SECONDS = 3 * 3600


def _revenue(src: str, ts: str, key: str, amount: str, fare: str) -> str:
    return f"""
SELECT time_bucket(INTERVAL 1 HOUR, {ts}) AS window_start,
       time_bucket(INTERVAL 1 HOUR, {ts}) + INTERVAL 1 HOUR AS window_end,
       {key},
       CAST(SUM(CAST({amount} AS DECIMAL(18,2))) AS DOUBLE) AS revenue_in_window,
       COUNT(*) AS trip_count,
       CAST(SUM(CAST({fare} AS DECIMAL(18,2))) AS DOUBLE) / COUNT({fare}) AS avg_fare
FROM {src} WHERE {ts} IS NOT NULL
GROUP BY ALL"""


def _volume(src: str, ts: str, key: str) -> str:
    return f"""
SELECT window_start, window_start + INTERVAL 30 MINUTE AS window_end, {key}, COUNT(*) AS trip_volume
FROM (
  SELECT time_bucket(INTERVAL 15 MINUTE, {ts}) - k * INTERVAL 15 MINUTE AS window_start, {key}
  FROM {src}, (SELECT unnest([0, 1]) AS k) ks
  WHERE {ts} IS NOT NULL
) w
GROUP BY ALL"""


# Fixed value: the shared nation table numbers its 25 rows 0 .. 24.
ZONE_IDS = range(25)


def _heatmap() -> str:
    cols = ",\n  ".join(
        [f'CAST(SUM(trip_volume) FILTER (WHERE PULocationID = {z}) AS BIGINT) AS "zone_{z}"' for z in ZONE_IDS]
        + ['CAST(SUM(trip_volume) FILTER (WHERE PULocationID IS NULL OR PULocationID NOT IN (SELECT n_nationkey FROM nation)) AS BIGINT) AS "zone_other"']
    )
    return f"""{SILVER_CTES},
vol AS ({_volume('silver', 'tpep_pickup_datetime', 'PULocationID')})
SELECT window_start, window_end,
  {cols}
FROM vol GROUP BY window_start, window_end"""


EVENT_SIDES = """
p AS (SELECT event_id AS pickup_id, ts AS pickup_ts, user_id FROM events WHERE event_id % 2 = 0),
d AS (SELECT event_id AS dropoff_id, ts AS dropoff_ts, user_id AS d_user FROM events WHERE event_id % 2 = 1)"""


def _trip_id_expr(prefix: str = "") -> str:
    def txt(c, ts=False):
        v = f"strftime({prefix}{c}, '%Y-%m-%d %H:%M:%S.%f')" if ts else f"CAST({prefix}{c} AS VARCHAR)"
        return f"coalesce({v}, '∅')"

    return (
        f"md5(concat_ws('|', {txt('VendorID')}, {txt('tpep_pickup_datetime', True)}, {txt('PULocationID')}))"
    )


TRIP_SIDES = f"""
pk AS (SELECT {_trip_id_expr()} AS trip_id, tpep_pickup_datetime AS pickup_ts, PULocationID, pickup_borough FROM silver),
dk AS (SELECT {_trip_id_expr()} AS d_trip_id, tpep_dropoff_datetime AS dropoff_ts, DOLocationID, dropoff_borough FROM silver)"""


def _impute() -> str:
    def key(col):
        base = (
            "md5(concat_ws('|', coalesce(CAST(VendorID AS VARCHAR), '∅'), "
            "coalesce(tpep_pickup_datetime, '∅'), coalesce(tpep_dropoff_datetime, '∅')))"
        )
        return f"CAST(('0x' || substr(md5({base} || '|{col}'), 1, 8)) AS BIGINT) % (SELECT count(*) FROM pool)"

    return f"""{_with(RAW, ZONES)},
pool AS (SELECT row_number() OVER (ORDER BY LocationID) - 1 AS idx, LocationID FROM (SELECT DISTINCT LocationID FROM zones WHERE LocationID IS NOT NULL)),
k AS (SELECT *, {key('PULocationID')} AS ku, {key('DOLocationID')} AS kd FROM raw)
SELECT VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance,
       coalesce(PULocationID, pu.LocationID) AS PULocationID,
       coalesce(DOLocationID, pd.LocationID) AS DOLocationID,
       fare_amount, tip_amount, total_amount
FROM k LEFT JOIN pool pu ON k.ku = pu.idx LEFT JOIN pool pd ON k.kd = pd.idx"""


ROLLING_HOURLY = """
WITH c AS (SELECT *, CAST(round(value * 100) AS BIGINT) AS cents, CAST(floor(epoch_us(ts) / 3600000000) AS BIGINT) AS h
           FROM events WHERE ts IS NOT NULL AND value IS NOT NULL),
m AS (SELECT event_type, h, count(*) AS mn, sum(cents) AS ms1, sum(CAST(cents AS HUGEINT) * cents) AS ms2 FROM c GROUP BY ALL),
r AS (SELECT event_type, h, sum(mn) OVER w AS n, sum(ms1) OVER w AS s1, sum(ms2) OVER w AS s2
      FROM m WINDOW w AS (PARTITION BY event_type ORDER BY h RANGE BETWEEN 23 PRECEDING AND CURRENT ROW)),
st AS (SELECT event_type, h, CAST(s1 AS DOUBLE) / n / 100.0 AS a,
              CASE WHEN n > 1 THEN sqrt(CAST(n * s2 - s1 * s1 AS DOUBLE) / CAST(n * (n - 1) AS DOUBLE) / 10000.0) END AS sd
       FROM r)
SELECT e.* FROM events e JOIN st ON e.event_type = st.event_type AND CAST(floor(epoch_us(e.ts) / 3600000000) AS BIGINT) = st.h
WHERE e.value > st.a + st.sd * 3.0"""



def _grid(volume: str, zone: str, zones: str, step: str, width: str) -> str:
    """Every window between the first and the last, every known zone and a null one, zero where ``vol`` has no row."""
    return f"""
vol AS ({volume}),
known AS ({zones}),
lab AS (SELECT window_start, known.z, sum(trip_volume) AS v FROM vol LEFT JOIN known ON vol.{zone} = known.z GROUP BY ALL),
cells AS (SELECT w.window_start, k.z FROM (SELECT unnest(generate_series((SELECT min(window_start) FROM vol), (SELECT max(window_start) FROM vol), INTERVAL {step})) AS window_start) w,
          (SELECT z FROM known UNION ALL SELECT NULL) k)
SELECT cells.window_start, cells.window_start + INTERVAL {width} AS window_end, cells.z AS {zone}, CAST(coalesce(v, 0) AS BIGINT) AS trip_volume
FROM cells LEFT JOIN lab ON lab.window_start = cells.window_start AND lab.z IS NOT DISTINCT FROM cells.z"""


_DAYS = """
SELECT time_bucket(INTERVAL 1 DAY, tpep_pickup_datetime) AS window_start, PULocationID, count(*) AS trip_volume
FROM silver WHERE tpep_pickup_datetime IS NOT NULL GROUP BY ALL"""


def _murmur3(text: str) -> str:
    """Spark's 32-bit hash (seed 42) of ASCII text: whole little-endian words, then single bytes.

    Fixed values of the published hash: multipliers 3432918353, 461845907, 5 and 3864292196,
    2246822507 and 3266489909; rotations 15 and 13; shifts 16, 13 and 16.
    """
    m = "4294967296"
    rot = lambda x, n: f"(({x} * {1 << n}) % {m} + ({x} // {1 << (32 - n)}))"
    k1 = f"(k * 3432918353) % {m}"
    steps = f"""
ch AS (SELECT o_orderkey, {text} AS s FROM orders),
by_ AS (SELECT o_orderkey, [CAST(ord(c) AS HUGEINT) for c in string_split(s, '')] AS b, length(s) AS n FROM ch),
wd AS (SELECT o_orderkey, n, list_concat([b[4 * i + 1] + b[4 * i + 2] * 256 + b[4 * i + 3] * 65536 + b[4 * i + 4] * 16777216 for i in range(0, n // 4)], b[n // 4 * 4 + 1:]) AS ks FROM by_),
mx AS (SELECT o_orderkey, n, [({rot('x', 15)} * 461845907) % {m} for x in [{k1} for k in ks]] AS ks FROM wd),
hs AS (SELECT o_orderkey, n, list_reduce(list_prepend(CAST(42 AS HUGEINT), ks), lambda h, k: ({rot('xor(h, k)', 13)} * 5 + 3864292196) % {m}) AS h FROM mx),
f1 AS (SELECT o_orderkey, xor(h, CAST(n AS HUGEINT)) AS h FROM hs),
f2 AS (SELECT o_orderkey, (xor(h, h // 65536) * 2246822507) % {m} AS h FROM f1),
f3 AS (SELECT o_orderkey, (xor(h, h // 8192) * 3266489909) % {m} AS h FROM f2),
f4 AS (SELECT o_orderkey, xor(h, h // 65536) AS h FROM f3)"""
    return f"WITH {steps} SELECT o_orderkey, CAST(CASE WHEN h >= 2147483648 THEN h - {m} ELSE h END AS INTEGER) AS trip_id FROM f4"


BATCH_ORACLE = {
    "heatmap_grid": f"""{SILVER_CTES}, {_grid(_DAYS, 'PULocationID', 'SELECT DISTINCT n_nationkey AS z FROM nation WHERE n_nationkey IS NOT NULL', '1 DAY', '1 DAY')}""",
    "heatmap_grid_events": f"""WITH {_grid(_volume('events', 'ts', 'event_type'), 'event_type', 'SELECT DISTINCT event_type AS z FROM events WHERE event_type IS NOT NULL', '15 MINUTE', '30 MINUTE')}""",
    "skew_layout": f"{_with(RAW)} SELECT * FROM raw",
    "trip_id_murmur3": _murmur3("concat_ws('|', CAST(o_custkey AS VARCHAR), strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f'), CAST(o_orderkey AS VARCHAR))"),
    "anomaly_clock": """
WITH s AS (SELECT event_type, avg(value) AS a, stddev_samp(value) AS sd FROM events GROUP BY event_type)
SELECT e.event_id, e.value, true AS flagged_now, true AS same_clock FROM events e JOIN s ON e.event_type = s.event_type WHERE e.value > s.a + s.sd * 3.0""",
    "anomaly_rolling_hourly": ROLLING_HOURLY,
    "revenue_hourly": f"{SILVER_CTES} {_revenue('silver', 'tpep_pickup_datetime', 'pickup_borough', 'total_amount', 'fare_amount')}",
    "revenue_hourly_events": _revenue("events", "ts", "event_type", "value", "value"),
    "volume_sliding": f"{SILVER_CTES} {_volume('silver', 'tpep_pickup_datetime', 'pickup_zone')}",
    "volume_sliding_events": _volume("events", "ts", "event_type"),
    "heatmap_pivot": _heatmap(),
    "quality_filters": f"{_with(RAW, QUALITY)} SELECT * FROM quality",
    "zone_enrich": f"{_with(RAW, ZONES, QUALITY)} {_enriched('quality')}",
    # the same results, with the input landed as CSV / JSON files first (SRC-5, SRC-6, SRC-9)
    "zone_enrich_csv": f"{_with(RAW, ZONES, QUALITY)} {_enriched('quality')}",
    "quality_filters_csv": f"{_with(RAW, QUALITY)} SELECT * FROM quality",
    "quality_filters_json": f"{_with(RAW, QUALITY)} SELECT * FROM quality",
    "quality_filters_parquet": f"{_with(RAW, QUALITY)} SELECT * FROM quality",
    "revenue_per_mile": f"""{_with(RAW, QUALITY)}
SELECT *, CASE WHEN trip_distance <> 0 THEN total_amount / trip_distance END AS revenue_per_mile FROM quality""",
    "dedup_batch": f"{_with(RAW, QUALITY, DEDUP)} SELECT * FROM dedup",
    "silver": f"{SILVER_CTES} SELECT * FROM silver",
    "zones_not_null_sql": f"{_with(RAW)} SELECT * FROM raw WHERE PULocationID IS NOT NULL AND DOLocationID IS NOT NULL",
    "anomaly_batch_stats": """
WITH s AS (SELECT event_type, avg(value) AS a, stddev_samp(value) AS sd FROM events GROUP BY event_type)
SELECT e.* FROM events e JOIN s ON e.event_type = s.event_type WHERE e.value > s.a + s.sd * 3.0""",
    "anomaly_silver": f"""{SILVER_CTES},
s AS (SELECT pickup_borough AS b, avg(fare_amount) AS a, stddev_samp(fare_amount) AS sd FROM silver GROUP BY 1)
SELECT silver.* FROM silver JOIN s ON silver.pickup_borough = s.b WHERE fare_amount > s.a + s.sd * 2.0""",
    "anomaly_rolling_24h": """
SELECT * EXCLUDE (a_, s_) FROM (
  SELECT e.*,
    count(value) OVER w AS roll_n,
    avg(value) OVER w AS a_, stddev_samp(value) OVER w AS s_
  FROM events e
  WHERE ts IS NOT NULL
  WINDOW w AS (PARTITION BY event_type ORDER BY epoch_us(ts) RANGE BETWEEN 86400000000 PRECEDING AND CURRENT ROW)
) t WHERE value > a_ + s_ * 3.0""",
    "anomaly_percentile": """
WITH t AS (SELECT event_type, quantile_disc(value, 0.99) AS fare_threshold FROM events GROUP BY event_type)
SELECT e.*, t.fare_threshold FROM events e JOIN t ON e.event_type = t.event_type WHERE e.value > t.fare_threshold""",
    "trip_id": """
SELECT o_orderkey, md5(concat_ws('|', coalesce(CAST(o_custkey AS VARCHAR), '∅'),
  coalesce(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f'), '∅'), coalesce(CAST(o_orderkey AS VARCHAR), '∅'))) AS trip_id
FROM orders""",
    "trip_matching": f"""{SILVER_CTES}, {TRIP_SIDES}
SELECT pk.trip_id, pickup_ts, PULocationID, pickup_borough, dropoff_ts, DOLocationID, dropoff_borough,
       (epoch_us(dropoff_ts) - epoch_us(pickup_ts)) / 60000000.0 AS actual_duration_minutes
FROM pk JOIN dk ON pk.trip_id = dk.d_trip_id
WHERE dropoff_ts >= pickup_ts AND dropoff_ts <= pickup_ts + INTERVAL {TRIP_SECONDS} SECOND""",
    "open_trips": f"""{SILVER_CTES}, {TRIP_SIDES}
SELECT * FROM pk WHERE NOT EXISTS (
  SELECT 1 FROM dk WHERE dk.d_trip_id = pk.trip_id
    AND dropoff_ts >= pickup_ts AND dropoff_ts <= pickup_ts + INTERVAL {TRIP_SECONDS} SECOND)""",
    "event_matching": f"""{_with(EVENT_SIDES)}
SELECT pickup_id, pickup_ts, user_id, dropoff_id, dropoff_ts,
       (epoch_us(dropoff_ts) - epoch_us(pickup_ts)) / 60000000.0 AS duration_minutes
FROM p JOIN d ON p.user_id = d.d_user
WHERE dropoff_ts >= pickup_ts AND dropoff_ts <= pickup_ts + INTERVAL {EVENT_SECONDS} SECOND""",
    "event_open": f"""{_with(EVENT_SIDES)}
SELECT * FROM p WHERE NOT EXISTS (
  SELECT 1 FROM d WHERE d.d_user = p.user_id
    AND dropoff_ts >= pickup_ts AND dropoff_ts <= pickup_ts + INTERVAL {EVENT_SECONDS} SECOND)""",
    "skew_agg": f"""{_with(RAW, QUALITY)}
SELECT PULocationID, COUNT(*) AS trip_count,
       CAST(SUM(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
       MAX(fare_amount) AS max_fare, COUNT(DISTINCT DOLocationID) AS distinct_dropoffs
FROM quality GROUP BY PULocationID""",
    "replay_batches": """
SELECT event_id, ts, CAST((row_number() OVER (ORDER BY ts, event_id) - 1) // 500 AS BIGINT) AS batch_no FROM events""",
    "zone_pool": f"""{_with(RAW)}
SELECT DISTINCT location_id FROM (
  SELECT PULocationID AS location_id FROM raw UNION ALL SELECT DOLocationID FROM raw) u
WHERE location_id IS NOT NULL""",
    "impute_zone": _impute(),
}
