"""Data-quality rollups and alerts as tables.

Events are reduced to one row per minute, stage and route first. The sliding rates and the alerts
work on those minute rows only, so their cost follows the length of the time span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from driftwell.config import (
    INVALID_RATE_PERCENT,
    LATENCY_P95_MS,
    LATENCY_SKETCH,
    RATE_WINDOW_MINUTES,
    REPLAY_RATE_PERCENT,
    SUSTAIN_MINUTES,
)

_RATE = f"{RATE_WINDOW_MINUTES} minutes"


def measure_latency(records: DataFrame) -> DataFrame:
    """Adds ``latency_ms``: arrival minus event time, cut to whole milliseconds toward zero."""
    return records.withColumn("latency_ms", latency_of())


def latency_of() -> Column:
    micros = F.unix_micros("arrival_ts") - F.unix_micros("event_timestamp")
    return (micros / 1000).cast("long")


def _minute(moment: str = "arrival_ts") -> Column:
    return F.date_trunc("minute", moment)


def stage_counts(routed: DataFrame) -> DataFrame:
    """Rows per minute of arrival, stage and route, from ``arrival_ts, stage, route``."""
    return (
        routed.groupBy(_minute().alias("minute"), "stage", "route")
        .agg(F.count("*").alias("events"))
        .select("minute", F.expr("minute + interval 1 minute").alias("minute_end"), "stage", "route", "events")
    )


def sliding(minute_rows: DataFrame) -> DataFrame:
    """Each minute row once per five-minute window that covers it, as ``window_end``."""
    ends = F.sequence(
        F.expr("minute + interval 1 minute"),
        F.expr(f"minute + interval {_RATE}"),
        F.expr("interval 1 minute"),
    )
    return minute_rows.withColumn("window_end", F.explode(ends))


def stage_rates(counts: DataFrame) -> DataFrame:
    """Events per minute over the last five minutes, evaluated every minute."""
    return (
        sliding(counts)
        .groupBy("window_end", "stage", "route")
        .agg(F.sum("events").alias("events"))
        .withColumn("events_per_minute", F.col("events") / F.lit(float(RATE_WINDOW_MINUTES)))
    )


def _route_sum(stage: str, *routes: str) -> Column:
    wanted = (F.col("stage") == stage) & F.col("route").isin(*routes)
    return F.coalesce(F.sum(F.when(wanted, F.col("events"))), F.lit(0))


def sustained(evaluations: DataFrame, before: int, minutes: int) -> DataFrame:
    """Adds ``firing``: ``breached`` held now and at the ``before`` evaluations, ``minutes`` apart, before.

    A moment without data breaches nothing, so it interrupts a run. Every evaluation is handed to the
    later ones it counts for, so the evaluations are made once and no join or global order is needed.
    """
    others = [c for c in evaluations.columns if c != "window_end"]
    handed = evaluations.select("*", F.explode(F.sequence(F.lit(0), F.lit(before))).alias("back")).withColumn(
        "window_end", F.expr(f"window_end + back * interval {minutes} minutes")
    )
    own = F.max(F.when(F.col("back") == 0, F.struct(*others))).alias("own")
    met = handed.groupBy("window_end").agg(own, F.sum(F.col("breached").cast("int")).alias("breaches"))
    return met.filter(F.col("own").isNotNull()).select(
        "window_end", "own.*", (F.col("breaches") == before + 1).alias("firing")
    )


def invalid_rates(windows: GroupedData) -> DataFrame:
    """The share of invalid messages per window of minute rows, and whether it is too high."""
    rates = windows.agg(
        _route_sum("validation", "valid").alias("valid_events"),
        _route_sum("validation", "invalid").alias("invalid_events"),
    ).withColumn(
        "invalid_percent",
        F.lit(100.0) * F.col("invalid_events") / F.nullif(F.col("valid_events") + F.col("invalid_events"), F.lit(0)),
    )
    return _breached(rates, F.col("invalid_percent") > INVALID_RATE_PERCENT)


def conflict_sums(windows: GroupedData) -> DataFrame:
    return windows.agg(_route_sum("conflict_check", "conflict").alias("conflict_events")).filter("conflict_events > 0")


def replay_rates(windows: GroupedData) -> DataFrame:
    """The share of replays among the registry's decisions per window, and whether it is too high."""
    rates = windows.agg(
        _route_sum("registry", "replay").alias("replay_events"),
        _route_sum("registry", "new", "replay", "conflict").alias("decided_events"),
    ).withColumn("replay_percent", F.lit(100.0) * F.col("replay_events") / F.nullif(F.col("decided_events"), F.lit(0)))
    return _breached(rates, F.col("replay_percent") > REPLAY_RATE_PERCENT).withColumnRenamed("breached", "firing")


def latency_p95(windows: GroupedData) -> DataFrame:
    """P95 per window of latency rollups, and whether it is too high."""
    merged = windows.agg(F.sum("events").alias("events"), F.expr("kll_merge_agg_bigint(sketch)").alias("sketch"))
    quantile = F.expr("kll_sketch_get_quantile_bigint(sketch, 0.95D)").cast("double")
    return _breached(merged.withColumn("p95_ms", quantile).drop("sketch"), F.col("p95_ms") > LATENCY_P95_MS)


def invalid_rate_alert(counts: DataFrame) -> DataFrame:
    return sustained(invalid_rates(sliding(counts).groupBy("window_end")), before=SUSTAIN_MINUTES, minutes=1)


def conflict_alert(counts: DataFrame) -> DataFrame:
    """Fires at once on any short-term conflict in the last five minutes."""
    return conflict_sums(sliding(counts).groupBy("window_end"))


def replay_rate_alert(counts: DataFrame) -> DataFrame:
    return replay_rates(sliding(counts).groupBy("window_end"))


def _breached(rates: DataFrame, condition: Column) -> DataFrame:
    return rates.withColumn("breached", F.coalesce(condition, F.lit(False)))


def latency_stats(measured: DataFrame) -> DataFrame:
    """Count, sum, least, largest and mean latency per minute of arrival."""
    return measured.groupBy(_minute().alias("minute")).agg(
        F.count("latency_ms").alias("events"),
        F.sum("latency_ms").alias("sum_ms"),
        F.min("latency_ms").alias("min_ms"),
        F.max("latency_ms").alias("max_ms"),
        F.avg("latency_ms").alias("mean_ms"),
    )


def latency_rollup(measured: DataFrame) -> DataFrame:
    """What the latency of a batch leaves behind per minute of arrival: totals, and a sketch of the distribution.

    The KLL sketch holds at most a few times ``LATENCY_SKETCH`` numbers however many events there are. Rows of
    several batches are merged by ``merged_latency``.
    """
    return measured.groupBy(_minute().alias("minute")).agg(
        F.count("latency_ms").alias("events"),
        F.sum("latency_ms").alias("sum_ms"),
        F.min("latency_ms").alias("min_ms"),
        F.max("latency_ms").alias("max_ms"),
        F.expr(f"kll_sketch_agg_bigint(latency_ms, {LATENCY_SKETCH})").alias("sketch"),
    )


def merged_latency(rollups: DataFrame, *keys: str | Column) -> DataFrame:
    """Rollup rows with equal keys (by minute, unless others are given) as one."""
    return rollups.groupBy(*(keys or ("minute",))).agg(
        F.sum("events").alias("events"),
        F.sum("sum_ms").alias("sum_ms"),
        F.min("min_ms").alias("min_ms"),
        F.max("max_ms").alias("max_ms"),
        F.expr("kll_merge_agg_bigint(sketch)").alias("sketch"),
    )


def latency_p95_windows(rollups: DataFrame) -> DataFrame:
    """P95 per aligned five-minute window from stored rollups alone.

    The share of the window's events up to ``p95_ms`` is 0.95 within ``LATENCY_RANK_ERROR`` (with a confidence of 99 %); it is
    exact for windows of fewer events than the sketch holds.
    """
    window_end = F.window("minute", _RATE).end
    return latency_p95(rollups.filter("events > 0").groupBy(window_end.alias("window_end"))).drop("breached")


def stored_latency_p95_alert(rollups: DataFrame) -> DataFrame:
    """As ``latency_p95_alert``, for the rows that streams store; a group's state is one sketch."""
    window_end = F.window("minute", _RATE).end
    p95 = latency_p95(rollups.filter("events > 0").groupBy(window_end.alias("window_end")))
    return sustained(p95, before=1, minutes=SUSTAIN_MINUTES)


def latency_p95_alert(measured: DataFrame) -> DataFrame:
    """Exact P95 per aligned five-minute window, firing once two windows in a row breach.

    Equal latencies are counted before the percentile, so a window's group holds its distinct
    milliseconds, not its events.
    """
    window_end = F.window("arrival_ts", _RATE).end
    distinct = measured.groupBy(window_end.alias("window_end"), "latency_ms").agg(F.count("*").alias("n"))
    p95 = distinct.groupBy("window_end").agg(
        F.sum("n").alias("events"), F.expr("percentile(latency_ms, 0.95D, n)").alias("p95_ms")
    )
    breached = _breached(p95, F.col("p95_ms") > LATENCY_P95_MS)
    return sustained(breached, before=1, minutes=SUSTAIN_MINUTES)
