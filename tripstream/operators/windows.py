"""Event-time window aggregates: WIN-1/2, AGG-1..3, AGG-9.

All are ``groupBy(window(...), key)`` so Spark aggregates partially in each
task before the shuffle (a hot borough is combined map-side). Money is summed
in whole cents (the scale is a parameter, finer input an error) and returned as double:
the sum is exact and does not depend on the order rows arrive in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstream.config import DEFAULT_PARAMS
from tripstream.functions.timestamps import epoch_micros, epoch_micros_of, wall_clock_of
from tripstream.session import materialized

SCALE = DEFAULT_PARAMS.money_scale
MONEY = f"decimal(18,{SCALE})"


def exact_money(col: str, scale: int = SCALE) -> Column:
    """The amount as a whole number of its smallest unit; an error where it is finer than that."""
    units = F.round(F.col(col) * 10**scale).cast("long")
    finer = F.abs(F.col(col) * 10**scale - units) > 1e-4
    return F.when(finer, F.raise_error(F.concat(F.lit(f"amount finer than {scale} decimals: "), F.col(col).cast("string")))).otherwise(units)


def money_sum(col: str, scale: int = SCALE) -> Column:
    return F.sum(exact_money(col, scale).cast("decimal(20,0)")).cast("double") / 10**scale


def money_avg(col: str) -> Column:
    """Exact cent sum over the count: one rounding, the same in any engine."""
    return money_sum(col) / F.count(col)


def flatten_window(df: DataFrame, name: str = "window") -> DataFrame:
    """window{start,end} -> window_start, window_end (first two columns)."""
    rest = [c for c in df.columns if c != name]
    return df.select(
        F.col(f"{name}.start").alias("window_start"), F.col(f"{name}.end").alias("window_end"), *rest
    )


def revenue_by_window(
    df: DataFrame,
    ts: str = "tpep_pickup_datetime",
    key: str = "pickup_borough",
    amount: str = "total_amount",
    fare: str = "fare_amount",
    duration: str = "1 hour",
    key_alias: str | None = None,
) -> DataFrame:
    """AGG-1 + AGG-2 over a tumbling window (WIN-1): revenue, trip count, average fare."""
    out = df.groupBy(F.window(ts, duration), F.col(key).alias(key_alias or key)).agg(
        money_sum(amount).alias("revenue_in_window"),
        F.count(F.lit(1)).alias("trip_count"),
        money_avg(fare).alias("avg_fare"),
    )
    return flatten_window(out)


def volume_by_sliding_window(
    df: DataFrame,
    ts: str = "tpep_pickup_datetime",
    key: str = "pickup_zone",
    duration: str = "30 minutes",
    slide: str = "15 minutes",
    key_alias: str | None = None,
) -> DataFrame:
    """AGG-3 over a sliding window (WIN-2): each row counts in duration/slide windows."""
    out = df.groupBy(F.window(ts, duration, slide), F.col(key).alias(key_alias or key)).agg(
        F.count(F.lit(1)).alias("trip_volume")
    )
    return flatten_window(out)


def volume_matrix(volume: DataFrame, zone_ids: list[int], key: str = "PULocationID") -> DataFrame:
    """AGG-9, wide: window x zone matrix for display, one column per zone id and one for all other rows.

    A column per id needs the ids on the driver; ``volume_grid`` is the form for any number of zones.

    The column set is the zone dimension's unique ids (names may repeat), so it does not
    depend on the trips, and the cells add up to the whole volume.
    """
    known = sorted(set(zone_ids))
    label = F.when(F.col(key).isin(known), F.concat(F.lit("zone_"), F.col(key).cast("string"))).otherwise("zone_other")
    return (
        volume.withColumn("_label", label).groupBy("window_start", "window_end")
        .pivot("_label", [f"zone_{z}" for z in known] + ["zone_other"])
        .agg(F.sum("trip_volume"))
    )


GRID_CHUNK = 10_000


def volume_grid(volume: DataFrame, zones: DataFrame, key: str, zone_key: str, slide: str) -> DataFrame:
    """AGG-9, long and dense: one row per window and zone, zero where nothing happened.

    ``volume``: window_start, window_end (wall clock), ``key``, trip_volume. The windows run from the first
    to the last one seen, ``slide`` apart; the zones are the distinct ids of ``zones.zone_key``
    and one null row for all other ids, so the cells add up to the whole volume. Only the two
    bounds pass through the driver: the grid is made by the tasks, in pieces of ``GRID_CHUNK``
    windows, and meets the volume in an equi-join. Without volume there is no grid.
    """
    spark = volume.sparkSession
    volume = materialized(volume, "volume")
    start, end = epoch_micros("window_start"), epoch_micros("window_end")
    r = volume.agg(F.min(start).alias("lo"), F.max(start).alias("hi"), F.min(end - start).alias("width")).first()
    step = int(spark.range(1).select(epoch_micros_of(F.expr(f"TIMESTAMP_NTZ'1970-01-01 00:00:00' + INTERVAL {slide}"))).first()[0])
    known = zones.select(F.col(zone_key).cast(volume.schema[key].dataType).alias("_zone")).dropna().distinct()
    counts = (
        volume.join(known, F.col(key) == F.col("_zone"), "left")
        .groupBy(F.col("window_start").alias("_at"), F.col("_zone").alias("_of")).agg(F.sum("trip_volume").alias("trip_volume"))
    )
    if r["lo"] is None:
        return volume.select("window_start", "window_end", key, "trip_volume").limit(0)
    n = (r["hi"] - r["lo"]) // step + 1
    rows = known.unionByName(spark.range(1).select(F.lit(None).cast(volume.schema[key].dataType).alias("_zone")))
    pieces = rows.withColumn("_first", F.explode(F.sequence(F.lit(0), F.lit(n - 1), F.lit(GRID_CHUNK)))).repartition("_zone", "_first")
    cells = pieces.withColumn("_i", F.explode(F.sequence("_first", F.least(F.col("_first") + GRID_CHUNK - 1, F.lit(n - 1)))))
    at = F.col("_i").cast("long") * step + r["lo"]
    cells = cells.withColumn("window_start", wall_clock_of(at)).withColumn("window_end", wall_clock_of(at + r["width"]))
    met = cells.join(counts, (F.col("window_start") == F.col("_at")) & F.col("_zone").eqNullSafe(F.col("_of")), "left")
    return met.select("window_start", "window_end", F.col("_zone").alias(key), F.coalesce("trip_volume", F.lit(0)).alias("trip_volume"))
