"""Zone enrichment: JON-1/2 (left joins to a role-played dimension), PRJ-2..4.

The zone table plays a role once per end of the trip. A role is a prefix and the id
column it resolves; its names are the zone table's own, prefixed. No join carries a
hint: Spark broadcasts the dimension when its bytes are below the session's threshold
and shuffles otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstream.functions.derived import revenue_per_mile
from tripstream.schemas import SILVER_COLUMNS

ROLES = {"pickup": "PULocationID", "dropoff": "DOLocationID"}


def resolve_role(trips: DataFrame, zones: DataFrame, role: str, id_column: str) -> DataFrame:
    """``trips`` with ``<role>_borough`` and ``<role>_zone``; unknown or null ids keep the trip, names null."""
    names = {c: f"{role}_{c.lower()}" for c in ("Borough", "Zone")}
    looked_up = zones.select(F.col("LocationID").alias(f"_{role}"), *[F.col(c).alias(n) for c, n in names.items()])
    return trips.join(looked_up, trips[id_column] == looked_up[f"_{role}"], "left").drop(f"_{role}")


def enrich_with_zones(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """JON-1 + JON-2 + PRJ-3: every role resolved, columns in Silver's order."""
    for role, id_column in ROLES.items():
        trips = resolve_role(trips, zones, role, id_column)
    return trips.select(*[c for c in SILVER_COLUMNS if c in trips.columns])


def add_revenue_per_mile(df: DataFrame) -> DataFrame:
    """PRJ-4."""
    return df.withColumn("revenue_per_mile", revenue_per_mile())
