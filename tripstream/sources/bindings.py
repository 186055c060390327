"""Bindings from the shared test tables to trips, zones and events.

The test data holds no taxi trips, so trips are derived from the order star
schema and zones from nation x region. The driver's data has no bad rows, so
``raw_trips`` damages a deterministic share of them by key; the same rules are
written as SQL in ``tripstream.plans.oracle`` so both engines see equal input.

Fixed damage rules (by key):
  passenger_count  null when l_orderkey % 17 = 0, else l_linenumber - 1
  trip_distance    0.0 when l_partkey % 11 = 0, else l_quantity
  PULocationID     null when l_orderkey % 19 = 0, 99 when l_orderkey % 23 = 0, else c_nationkey
  DOLocationID     null when l_partkey % 29 = 0, else s_nationkey
  fare_amount      l_extendedprice - 2000 when l_suppkey % 2 = 0, else 1.5
  tip_amount       price x discount, in whole cents (half up)
  total_amount     price x (1 - discount) x (1 + tax), in whole cents (half up)
  pickup text      'not a time' when l_orderkey % 37 = 0, else o_orderdate as text
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TS_TEXT = "yyyy-MM-dd HH:mm:ss"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone dimension: LocationID=n_nationkey, Zone=n_name, Borough=r_name."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.col("r_name").alias("service_zone"),
    )


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed trip records with text timestamps and damaged fields.

    lineitem x (orders x customer) x supplier; every join is an equi-join that
    Catalyst/AQE plan by size (orders and customer grow with the data, so no
    broadcast is forced here). Orders get their nation first: they are fewer and
    narrower, so the rows of lineitem move once.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
    )
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = (
        li.join(o.join(c, o.o_custkey == c.c_custkey), li.l_orderkey == F.col("o_orderkey"))
        .join(s, li.l_suppkey == s.s_suppkey)
    )
    ok, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    price = F.col("l_extendedprice")
    # money in exact integer cents, so every engine derives the same amounts
    cents = F.round(price * 100).cast("long")
    disc = F.round(F.col("l_discount") * 100).cast("long")
    tax = F.round(F.col("l_tax") * 100).cast("long")
    total_c = cents * (100 - disc) * (100 + tax) + 5000
    return j.select(
        sk.cast("int").alias("VendorID"),
        F.when(ok % 37 == 0, F.lit("not a time"))
        .otherwise(F.date_format("o_orderdate", TS_TEXT))
        .alias("tpep_pickup_datetime"),
        F.date_format("l_shipdate", TS_TEXT).alias("tpep_dropoff_datetime"),
        F.when(ok % 17 == 0, F.lit(None).cast("int"))
        .otherwise(F.col("l_linenumber") - 1)
        .alias("passenger_count"),
        F.when(pk % 11 == 0, F.lit(0.0)).otherwise(F.col("l_quantity")).alias("trip_distance"),
        F.when(ok % 19 == 0, F.lit(None).cast("int"))
        .when(ok % 23 == 0, F.lit(99))
        .otherwise(F.col("c_nationkey"))
        .alias("PULocationID"),
        F.when(pk % 29 == 0, F.lit(None).cast("int"))
        .otherwise(F.col("s_nationkey"))
        .alias("DOLocationID"),
        F.when(sk % 2 == 0, price - 2000).otherwise(F.lit(1.5)).alias("fare_amount"),
        (F.floor((cents * disc + 50) / 100) / 100.0).alias("tip_amount"),
        (F.floor(total_c / 10000) / 100.0).alias("total_amount"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")
