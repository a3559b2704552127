"""Event time, fixed windows and lateness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwell.config import ALLOWED_LATENESS_SECONDS, REQUIRED_FIELDS, SENSORS, WINDOW_SECONDS
from driftwell.functions.times import plus_seconds


def assign_event_time(records: DataFrame) -> DataFrame:
    return records.withColumn("event_time", F.col("event_timestamp"))


def assign_window(records: DataFrame) -> DataFrame:
    """Adds the bounds of the fixed event-time window each row falls in. No shuffle."""
    window = F.window("event_timestamp", f"{WINDOW_SECONDS} seconds")
    return (
        records.withColumn("_window", window)
        .withColumn("window_start", F.col("_window.start"))
        .withColumn("window_end", F.col("_window.end"))
        .drop("_window")
    )


def classify_lateness(windowed: DataFrame) -> DataFrame:
    """on_time, late or dropped, by the arrival clock against the end of the row's window."""
    closes = plus_seconds(F.col("window_end"), ALLOWED_LATENESS_SECONDS)
    return windowed.withColumn(
        "lateness",
        F.when(F.col("arrival_ts") < F.col("window_end"), "on_time")
        .when(F.col("arrival_ts") < closes, "late")
        .otherwise("dropped"),
    )


def silver_rows(windowed: DataFrame) -> DataFrame:
    return windowed.select(*REQUIRED_FIELDS, "window_start", "window_end")


def gold_input_rows(windowed: DataFrame) -> DataFrame:
    return windowed.select(
        "event_id", "device_id", "event_timestamp", "window_start", "window_end", *SENSORS
    )


def event_time_rows(records: DataFrame) -> DataFrame:
    return records.select("event_id", "device_id", "event_timestamp")
