"""LAY-1: skew repair for a hot grouping key.

Sums, counts and extremes combine before the shuffle, so a plain ``groupBy`` is already
safe for them. What is left are steps that must move the rows themselves:

* an exact distinct count: the values meet per (key, value) first, which spreads a hot key
  over its values and combines map-side, and only one row per distinct value remains;
* laying a table out by key: all rows of a hot key would go to one task. A top-k sketch
  finds the few keys that hold a large share, and only their rows get a salt.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstream.operators.windows import money_sum

#: keys the sketch tracks; a key's count is off by at most about rows / TRACKED
TRACKED = 10_000


def trip_totals(df: DataFrame, key: str = "PULocationID", amount: str = "total_amount", fare: str = "fare_amount", value: str = "DOLocationID") -> DataFrame:
    """Per key: trips, revenue, max fare and the exact number of distinct ``value``s, in two phases."""
    part = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("_c"), money_sum(amount).alias("_s"), F.max(fare).alias("_m"))
    return part.groupBy(key).agg(
        F.sum("_c").alias("trip_count"), money_sum("_s").alias("revenue"),
        F.max("_m").alias("max_fare"), F.count(value).alias("distinct_dropoffs"))


def heavy_keys(df: DataFrame, key: str, share: float) -> tuple[int, list[tuple]]:
    """Rows of ``df``, and (key, about how many rows) for every key with at least ``share`` of them.

    One pass; the sketch merges map-side and hands the driver at most ``1 / share`` keys. Null
    is a key like any other.
    """
    k = min(TRACKED, math.ceil(1 / share))
    r = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(key).isNull()).alias("nulls"), F.expr(f"approx_top_k(`{key}`, {k}, {TRACKED})").alias("top")).first()
    top = [(x["item"], x["count"]) for x in r["top"] or [] if x["item"] is not None] + [(None, r["nulls"])]
    return r["n"], [(v, c) for v, c in top if c and c >= share * r["n"]]


def salted_layout(df: DataFrame, key: str, parts: int) -> DataFrame:
    """``df`` dealt into ``parts`` ranges by key, the rows of keys larger than a range spread over several.

    Each range is sorted by the key, so files written from it hold few keys and their
    statistics prune. A heavy key gets a salt per half range's worth of its rows; all other
    keys stay whole. The salt counts rows within the input partition, so equal rows part too;
    a task that runs again deals its rows alike as long as it reads the same input (a stored
    table does).
    """
    n, heavy = heavy_keys(df, key, 1 / (2 * parts))
    salts = F.lit(1)
    for value, count in heavy:  # at most 2 * parts of them
        salts = F.when(F.col(key).eqNullSafe(F.lit(value)), math.ceil(2 * parts * count / n)).otherwise(salts)
    dealt = df.withColumn("_salts", salts)
    dealt = dealt.withColumn("_salt", F.when(F.col("_salts") > 1, F.pmod(F.hash(F.monotonically_increasing_id()), F.col("_salts"))).otherwise(0)).drop("_salts")
    return dealt.repartitionByRange(parts, key, "_salt").sortWithinPartitions(key).drop("_salt")
