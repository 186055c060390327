"""Derived measures (PRJ-4, PRJ-9)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripstream.functions.timestamps import epoch_micros


def revenue_per_mile(total: str = "total_amount", distance: str = "trip_distance") -> Column:
    """total / distance; null when distance is 0 or null (no zero-division error under ANSI)."""
    d = F.col(distance)
    return F.when(d != 0, F.col(total) / d)


def duration_minutes(start: str, end: str) -> Column:
    """(end - start) in minutes, from wall-clock timestamps."""
    return (epoch_micros(end) - epoch_micros(start)) / F.lit(60_000_000.0)
