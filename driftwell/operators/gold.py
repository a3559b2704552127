"""Per-device aggregates over event-time and arrival-time windows.

All of them are built-in mergeable aggregates: each map task reduces its own rows first, so one
busy device costs its reducer one row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwell.config import WINDOW_SECONDS
from driftwell.schemas import GOLD

_WINDOW_KEYS = ("window_start", "window_end")


def gold_metrics():
    return [
        F.count("*").alias("event_count"),
        F.avg("temperature").alias("avg_temperature"),
        F.min("temperature").alias("min_temperature"),
        F.max("temperature").alias("max_temperature"),
        F.avg("humidity").alias("avg_humidity"),
        F.avg("pressure").alias("avg_pressure"),
        F.avg("battery_level").alias("avg_battery_level"),
    ]


def gold(windowed: DataFrame) -> DataFrame:
    """One complete row per device and window; nulls count as events but not as measurements."""
    return windowed.groupBy("device_id", *_WINDOW_KEYS).agg(*gold_metrics()).select(*GOLD.names)


def gold_panes(classified: DataFrame) -> DataFrame:
    """The discarding view: one on-time pane per device and window, one pane per late row.

    One grouping in one pass: a late row's own (event_id, arrival_ts, arrival_seq) is part of its key.
    """
    row_id = [c for c in ("event_id", "arrival_ts", "arrival_seq") if c in classified.columns]
    kept = classified.filter(F.col("lateness").isin("on_time", "late"))
    late_row = F.when(F.col("lateness") == "late", F.struct(*row_id))
    panes = kept.groupBy("device_id", *_WINDOW_KEYS, F.col("lateness").alias("pane"), late_row.alias("late_row"))
    return panes.agg(*gold_metrics()).select(*GOLD.names, "pane", F.col("late_row.event_id").alias("late_event_id"))


def late_panes(classified: DataFrame) -> DataFrame:
    """Each late row as a pane of its own: the aggregates of one row are its measurements."""
    late = classified.filter("lateness = 'late'")
    values = {"event_count": F.lit(1).cast("long")}
    values |= {name: F.col(name.split("_", 1)[1]) for name in GOLD.names if name.startswith(("avg_", "min_", "max_"))}
    columns = [values.get(name, F.col(name)).alias(name) for name in GOLD.names]
    return late.select(*columns, F.lit("late").alias("pane"), F.col("event_id").alias("late_event_id"))


def device_window_counts(windowed: DataFrame) -> DataFrame:
    return windowed.groupBy("device_id", *_WINDOW_KEYS).agg(F.count("*").alias("record_count"))


def device_arrival_counts(records: DataFrame) -> DataFrame:
    """Rows per device and fixed window of the arrival clock."""
    window = F.window("arrival_ts", f"{WINDOW_SECONDS} seconds")
    return (
        records.groupBy("device_id", window.alias("w"))
        .agg(F.count("*").alias("record_count"))
        .select("device_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "record_count")
    )
