"""Table sinks: SNK-9 (partitioned Gold), SNK-12 (exactly-once audit)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_date(df: DataFrame, ts: str = "window_start", name: str = "date") -> DataFrame:
    """Derived partition column for SNK-9."""
    return df.withColumn(name, F.to_date(F.col(ts)))


def clustered(df: DataFrame, columns: list[str]) -> DataFrame:
    """SNK-9: rows of one partition directory meet in one task before a partitioned write.

    Without it every task that holds a row of a directory writes its own file there; with it a
    directory gets one file per write. Meant for aggregated tables, whose directories hold few
    rows each; a table of raw rows is better served by ``operators.skew.salted_layout``.
    """
    return df.repartition(*columns)


def exactly_once_audit(source: DataFrame, table: DataFrame) -> DataFrame:
    """SNK-12: row counts both sides, plus rows missing from / extra in the table.

    Both sides are tagged and grouped by every column in one shuffle (the
    counts combine map-side, so a row repeated a million times is cheap);
    a row written twice shows as an extra row, one never written as missing.
    """
    cols = source.columns
    s = source.select(*cols, F.lit(1).alias("_ns"), F.lit(0).alias("_nt"))
    t = table.select(*cols, F.lit(0).alias("_ns"), F.lit(1).alias("_nt"))
    per_row = s.unionByName(t).groupBy(*cols).agg(F.sum("_ns").alias("ns"), F.sum("_nt").alias("nt"))
    return per_row.agg(
        F.coalesce(F.sum("ns"), F.lit(0)).cast("long").alias("source_rows"),
        F.coalesce(F.sum("nt"), F.lit(0)).cast("long").alias("table_rows"),
        F.coalesce(F.sum(F.greatest(F.col("ns") - F.col("nt"), F.lit(0))), F.lit(0)).cast("long").alias("missing_rows"),
        F.coalesce(F.sum(F.greatest(F.col("nt") - F.col("ns"), F.lit(0))), F.lit(0)).cast("long").alias("extra_rows"),
    )
