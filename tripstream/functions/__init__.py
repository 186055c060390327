from tripstream.functions.timestamps import parse_timestamp, to_instant, to_wall_clock, epoch_micros
from tripstream.functions.ids import trip_id, pool_index
from tripstream.functions.derived import revenue_per_mile, duration_minutes

__all__ = [
    "parse_timestamp",
    "to_instant",
    "to_wall_clock",
    "epoch_micros",
    "trip_id",
    "pool_index",
    "revenue_per_mile",
    "duration_minutes",
]
