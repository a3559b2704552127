"""Rates and alerts as running queries over the minute rows that the ingest stores.

A sliding window sums the minutes; where an alert has to hold for a while, a second, chained window gathers the
evaluations that a moment depends on (``window_time`` carries the watermark from the first to the second). State holds
the open windows only, a few rows per minute whatever the traffic. A row is written once it is final: ``wait_seconds``
after its last minute, and for sustained alerts after the last moment that it counts for. Minutes that come later than
that are left out here; the batch functions of ``operators.quality`` over the same tables count them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from driftwell.config import ALERT_WAIT_SECONDS, RATE_WINDOW_MINUTES, SUSTAIN_MINUTES
from driftwell.operators import quality
from driftwell.session import configure
from driftwell.sources.tables import Tables

_RATE = f"{RATE_WINDOW_MINUTES} minutes"


def _by_window(minute_rows: DataFrame, wait_seconds: int, slide: str, *keys: str) -> GroupedData:
    watched = minute_rows.withWatermark("minute", f"{wait_seconds} seconds")
    return watched.groupBy(F.window("minute", _RATE, slide).alias("evaluated"), *keys)


def _at_window_end(evaluations: DataFrame) -> DataFrame:
    others = [c for c in evaluations.columns if c != "evaluated"]
    return evaluations.select(F.col("evaluated.end").alias("window_end"), *others)


def _sustained(evaluations: DataFrame, before: int, minutes: int) -> DataFrame:
    """``quality.sustained`` on a stream: each evaluation falls into the windows that end at the moments it counts for."""
    others = [c for c in evaluations.columns if c != "evaluated"]
    held = F.window(F.window_time("evaluated"), f"{(before + 1) * minutes} minutes", f"{minutes} minutes")
    handed = evaluations.select("*", F.col("evaluated.end").alias("at"), held.alias("held"))
    own = F.max(F.when(F.col("at") == F.col("held.end"), F.struct(*others))).alias("own")
    met = handed.groupBy("held").agg(own, F.sum(F.col("breached").cast("int")).alias("breaches"))
    return met.filter(F.col("own").isNotNull()).select(
        F.col("held.end").alias("window_end"), "own.*", (F.col("breaches") == before + 1).alias("firing")
    )


def stage_rates_stream(counts: DataFrame, wait_seconds: int = ALERT_WAIT_SECONDS) -> DataFrame:
    sums = _by_window(counts, wait_seconds, "1 minute", "stage", "route").agg(F.sum("events").alias("events"))
    return _at_window_end(sums).withColumn("events_per_minute", F.col("events") / F.lit(float(RATE_WINDOW_MINUTES)))


def invalid_rate_stream(counts: DataFrame, wait_seconds: int = ALERT_WAIT_SECONDS) -> DataFrame:
    return _sustained(quality.invalid_rates(_by_window(counts, wait_seconds, "1 minute")), before=SUSTAIN_MINUTES, minutes=1)


def conflict_stream(counts: DataFrame, wait_seconds: int = ALERT_WAIT_SECONDS) -> DataFrame:
    return _at_window_end(quality.conflict_sums(_by_window(counts, wait_seconds, "1 minute")))


def replay_rate_stream(counts: DataFrame, wait_seconds: int = ALERT_WAIT_SECONDS) -> DataFrame:
    return _at_window_end(quality.replay_rates(_by_window(counts, wait_seconds, "1 minute")))


def latency_p95_stream(rollups: DataFrame, wait_seconds: int = ALERT_WAIT_SECONDS) -> DataFrame:
    evaluated = quality.latency_p95(_by_window(rollups.filter("events > 0"), wait_seconds, _RATE))
    return _sustained(evaluated, before=1, minutes=SUSTAIN_MINUTES)


# Table written, table read, and the query between them.
STREAMS: dict[str, tuple[str, Callable[[DataFrame, int], DataFrame]]] = {
    "stage_rates": ("stage_counts", stage_rates_stream),
    "alert_invalid_rate": ("stage_counts", invalid_rate_stream),
    "alert_conflict": ("stage_counts", conflict_stream),
    "alert_replay_rate": ("stage_counts", replay_rate_stream),
    "alert_latency_p95": ("latency", latency_p95_stream),
}


def start_alert(name: str, tables: Tables, checkpoint: str, wait_seconds: int = ALERT_WAIT_SECONDS, files_per_batch: int = 1000, **trigger) -> StreamingQuery:
    """One of ``STREAMS``, written to the table of its name."""
    configure(tables.spark)
    source, evaluate = STREAMS[name]
    return (
        evaluate(tables.stream(source, files_per_batch), wait_seconds)
        .writeStream.queryName(name)
        .outputMode("append")
        .foreachBatch(lambda rows, batch_id: tables.write(rows, name, batch_id))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )
