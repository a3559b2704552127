"""The eight optional debug outputs, all projections or counts of the regular stages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwell.operators import gold, windows

DEBUG_TABLES = [
    "event_time_window_debug",
    "arrival_count_debug",
    "event_timestamp_debug",
    "event_time_count_debug",
    "event_time_group_count_debug",
    "gold_input_debug",
    "gold_group_debug",
    "arrival_group_debug",
]


def debug_outputs(telemetry: DataFrame, new: DataFrame) -> dict[str, DataFrame]:
    """From the accepted records and the new ones; counts carry their window bounds."""
    windowed, windowed_new = windows.assign_window(telemetry), windows.assign_window(new)
    outputs = [
        windows.event_time_rows(windowed),
        gold.device_arrival_counts(telemetry),
        windows.event_time_rows(telemetry),
        gold.device_window_counts(windowed),
        gold.device_window_counts(windowed),
        windows.gold_input_rows(windowed_new),
        gold.device_window_counts(windowed_new),
        gold.device_arrival_counts(new),
    ]
    return dict(zip(DEBUG_TABLES, outputs, strict=True))


def summed(partial: DataFrame) -> DataFrame:
    """Whole counts from the partial ones that batches write: one row per device and window."""
    keys = [c for c in partial.columns if c not in ("record_count", "batch_id")]
    return partial.groupBy(*keys).agg(F.sum("record_count").alias("record_count"))
