"""Explicit schemas. Streams never infer: file streams need a schema up front.

Fixed values: the public trip record layout, the zone lookup's columns and the
Silver layout must match in name, type and order.
"""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# Raw trip record as landed (timestamps are text until Silver parses them).
TRIP_RAW_SCHEMA = StructType(
    [
        StructField("VendorID", IntegerType(), True),
        StructField("tpep_pickup_datetime", StringType(), True),
        StructField("tpep_dropoff_datetime", StringType(), True),
        StructField("passenger_count", IntegerType(), True),
        StructField("trip_distance", DoubleType(), True),
        StructField("RatecodeID", IntegerType(), True),
        StructField("store_and_fwd_flag", StringType(), True),
        StructField("PULocationID", IntegerType(), True),
        StructField("DOLocationID", IntegerType(), True),
        StructField("payment_type", IntegerType(), True),
        StructField("fare_amount", DoubleType(), True),
        StructField("extra", DoubleType(), True),
        StructField("mta_tax", DoubleType(), True),
        StructField("tip_amount", DoubleType(), True),
        StructField("tolls_amount", DoubleType(), True),
        StructField("improvement_surcharge", DoubleType(), True),
        StructField("total_amount", DoubleType(), True),
    ]
)

# The 10-column subset the unit fixtures and the table bindings carry.
TRIP_CORE_SCHEMA = StructType(
    [
        f
        for f in TRIP_RAW_SCHEMA.fields
        if f.name
        in (
            "VendorID",
            "tpep_pickup_datetime",
            "tpep_dropoff_datetime",
            "passenger_count",
            "trip_distance",
            "PULocationID",
            "DOLocationID",
            "fare_amount",
            "tip_amount",
            "total_amount",
        )
    ]
)

ZONE_SCHEMA = StructType(
    [
        StructField("LocationID", IntegerType(), True),
        StructField("Borough", StringType(), True),
        StructField("Zone", StringType(), True),
        StructField("service_zone", StringType(), True),
    ]
)

# Silver: wall-clock timestamps (no zone), zones resolved, revenue per mile.
SILVER_SCHEMA = StructType(
    [
        StructField("VendorID", IntegerType(), True),
        StructField("tpep_pickup_datetime", TimestampNTZType(), True),
        StructField("tpep_dropoff_datetime", TimestampNTZType(), True),
        StructField("passenger_count", IntegerType(), True),
        StructField("trip_distance", DoubleType(), True),
        StructField("PULocationID", IntegerType(), True),
        StructField("DOLocationID", IntegerType(), True),
        StructField("pickup_borough", StringType(), True),
        StructField("pickup_zone", StringType(), True),
        StructField("dropoff_borough", StringType(), True),
        StructField("dropoff_zone", StringType(), True),
        StructField("fare_amount", DoubleType(), True),
        StructField("tip_amount", DoubleType(), True),
        StructField("total_amount", DoubleType(), True),
        StructField("revenue_per_mile", DoubleType(), True),
    ]
)

SILVER_COLUMNS = [f.name for f in SILVER_SCHEMA.fields]

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"
