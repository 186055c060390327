"""Feeding an event-time stream in time order from a stored table.

A table is cut into a constant number of time slices. Each slice is landed by one job as
wide as the table allows, and the stream then runs over what is new on its one checkpoint
(``availableNow``), so order, restart and state eviction are all real, while the number of
driver steps does not grow with the rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripstream.functions.timestamps import epoch_micros
from tripstream.sources.streams import JSON_LANDING_OPTIONS

SLICES = 4
HOUR_US = 3_600_000_000


def slice_bounds(df: DataFrame, ts: str, n: int = SLICES, unit_us: int = HOUR_US) -> list[int]:
    """Inner bounds (epoch microseconds) of ``n`` equal slices, at whole units of time."""
    r = df.agg(F.min(epoch_micros(ts)).alias("lo"), F.max(epoch_micros(ts)).alias("hi")).first()
    if r["lo"] is None:
        return []
    return [(r["lo"] + (r["hi"] - r["lo"]) * k // n) // unit_us * unit_us for k in range(1, n)]


def slice_number(ts: str, bounds: list[int]) -> Column:
    """Slice of a row, from 0; a row without a time belongs to the first."""
    m = epoch_micros(ts)
    return sum((F.coalesce((m >= b).cast("int"), F.lit(0)) for b in bounds), F.lit(0))


def land_in_slices(
    df: DataFrame,
    ts: str,
    path: str,
    after_each: Callable[[int], None],
    n: int = SLICES,
    held: Column | None = None,
    fmt: str = "parquet",
    columns: list[str] | None = None,
    unit_us: int = HOUR_US,
) -> None:
    """Append slice by slice below ``path``, calling ``after_each(k)`` when slice ``k`` has landed.

    Rows for which ``held`` is true arrive with the last slice, whatever their time.
    ``columns``: what is written (all but the helper columns of ``df`` by default). ``unit_us``:
    slices are cut at whole units of this length (1: anywhere, so inside hours).
    """
    k_of = slice_number(ts, slice_bounds(df, ts, n, unit_us))
    if held is not None:
        k_of = F.when(F.coalesce(held, F.lit(False)), n - 1).otherwise(k_of)
    for k in range(n):
        part = df.filter(k_of == k).select(*(columns or df.columns))
        part.write.mode("append").options(**(JSON_LANDING_OPTIONS if fmt == "json" else {})).format(fmt).save(path)
        after_each(k)
