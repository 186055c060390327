"""Numbered batches and zone-id filling: SRT-2, SET-1, PRJ-10, AGG-8.

A global row position comes from ``running_sums`` over range partitions, never from one
window over all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstream.config import DEFAULT_PARAMS
from tripstream.functions.ids import pool_index, trip_id
from tripstream.operators.anomaly import running_sums
from tripstream.session import materialized


def global_index(df: DataFrame, order: list[str], name: str = "row_index", parts: int | None = None) -> DataFrame:
    """0-based position of each row in ``order`` (rows that tie in it take any of their places)."""
    one = df.withColumn("_all", F.lit(1)).withColumn("_one", F.lit(1).cast("long"))
    return running_sums(one, "_all", order, ["_one"], parts).select(*df.columns, (F.col("_one") - 1).alias(name))


def cut_batches(df: DataFrame, order: list[str], batch_rows: int = DEFAULT_PARAMS.landing_batch_rows, name: str = "batch_no") -> DataFrame:
    """SRT-2: consecutive batches of ``batch_rows`` rows in ``order``; a short last batch is kept."""
    idx = global_index(df, order, "_row")
    return idx.withColumn(name, F.floor(F.col("_row") / F.lit(batch_rows)).cast("long")).drop("_row")


def observed_zone_ids(trips: DataFrame, pu: str = "PULocationID", do: str = "DOLocationID") -> DataFrame:
    """SET-1 (observed branch) + AGG-8: distinct non-null ids seen on either side, in one pass."""
    return trips.select(F.explode(F.array(pu, do)).alias("location_id")).dropna().distinct()


def zone_pool(spark, zones: DataFrame | None = None, trips: DataFrame | None = None) -> DataFrame:
    """SET-1: lookup ids if any; else ids observed in trips; else 1..263."""
    if zones is not None:
        ids = zones.select(F.col("LocationID").alias("location_id")).dropna().distinct()
        if not ids.isEmpty():
            return ids
    if trips is not None:
        ids = observed_zone_ids(trips)
        if not ids.isEmpty():
            return ids
    return spark.range(1, 264).select(F.col("id").cast("int").alias("location_id"))


def impute_zone_ids(
    df: DataFrame,
    pool: DataFrame,
    cols=("PULocationID", "DOLocationID"),
    key_cols=("VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime"),
) -> DataFrame:
    """PRJ-10: fill null zone ids with a pick from the pool, seeded by the row's own fields.

    Unlike a partition-dependent random draw, the pick is a pure function of the row, so
    re-running a task (or the whole job) gives the same ids. The pool may have any size:
    it is joined on its position.
    """
    indexed = materialized(global_index(pool, ["location_id"], "_pool_idx"), "zone-pool")
    size = indexed.count()
    base = trip_id(df, list(key_cols))
    out = df
    for c in cols:
        pick = indexed.select(F.col("_pool_idx").alias(f"_i_{c}"), F.col("location_id").alias(f"_v_{c}"))
        out = out.withColumn(f"_k_{c}", pool_index(F.concat(base, F.lit(f"|{c}")), F.lit(size)))
        out = out.join(pick, out[f"_k_{c}"] == pick[f"_i_{c}"], "left")
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"_v_{c}").cast(df.schema[c].dataType)))
        out = out.drop(f"_k_{c}", f"_i_{c}", f"_v_{c}")
    return out.select(*df.columns)
