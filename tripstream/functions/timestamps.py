"""Timestamp helpers (SCL-1, SCL-10).

Batch plans carry wall-clock timestamps (``timestamp_ntz``) so results do not
depend on the session time zone. Watermarks need an instant type
(``timestamp``), so stream plans convert at their edges through epoch
microseconds, which is zone-free in both directions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _name(col: str) -> str:
    if not isinstance(col, str):
        raise TypeError("pass a column name")
    return "`" + col.replace("`", "``") + "`"


def parse_timestamp(col) -> Column:
    """Text -> wall-clock timestamp; malformed text gives null, never an error."""
    return _c(col).try_cast("timestamp_ntz")


def epoch_micros(col: str) -> Column:
    """Microseconds since 1970-01-01 of a wall-clock timestamp, read as UTC."""
    return F.expr(f"timestampdiff(MICROSECOND, {_EPOCH_NTZ}, {_name(col)})")


def epoch_micros_of(c: Column) -> Column:
    """The same of a wall-clock expression."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), c)


def wall_clock_of(micros: Column) -> Column:
    """Wall-clock timestamp of microseconds since 1970-01-01 (zone-independent)."""
    return F.timestamp_add("MICROSECOND", micros, F.expr(_EPOCH_NTZ))


def to_instant(col: str) -> Column:
    """Wall-clock -> instant, reading the wall clock as UTC (zone-independent)."""
    return F.timestamp_micros(epoch_micros(col))


def to_wall_clock(col: str) -> Column:
    """Instant -> wall-clock in UTC (zone-independent)."""
    return F.expr(f"timestampadd(MICROSECOND, unix_micros({_name(col)}), {_EPOCH_NTZ})")
