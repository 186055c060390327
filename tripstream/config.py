"""Pipeline parameters.

Fixed values that must equal the reference pipeline's settings for equal
results: landing batch 500 rows, 1 file per Bronze trigger and 5 per downstream trigger, a 3 s trigger,
watermarks Silver 10 min / revenue 30 min / volume 15 min / anomaly 10 min /
completed trips 3 h, fare threshold 3.0 standard deviations, tumbling window
1 hour, sliding window 30 minutes every 15 minutes.
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Params:
    # landing / replay
    landing_batch_rows: int = 500
    # triggers
    bronze_files_per_trigger: int = 1
    table_files_per_trigger: int = 5
    trigger_interval: str = "3 seconds"
    # watermarks
    silver_watermark: str = "10 minutes"
    revenue_watermark: str = "30 minutes"
    volume_watermark: str = "15 minutes"
    anomaly_watermark: str = "10 minutes"
    completed_watermark: str = "3 hours"
    # windows
    revenue_window: str = "1 hour"
    volume_window: str = "30 minutes"
    volume_slide: str = "15 minutes"
    # anomaly detection
    fare_sigma: float = 3.0
    rolling_stats_seconds: int = 24 * 3600
    # longest trip accepted by the pickup/dropoff match
    max_trip_seconds: int = 3 * 3600
    # decimal places of money amounts; finer amounts are an error, not rounded away
    money_scale: int = 2

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


DEFAULT_PARAMS = Params()
