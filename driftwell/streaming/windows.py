"""Streaming aggregates: gold over event time, counts over the arrival clock."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from driftwell.config import (
    ALLOWED_LATENESS_SECONDS,
    DISORDER_SECONDS,
    FOLD_EVERY,
    MAX_FUTURE_SECONDS,
    WINDOW_SECONDS,
)
from driftwell.operators.gold import device_arrival_counts, gold_metrics, late_panes
from driftwell.operators.windows import classify_lateness
from driftwell.schemas import GOLD, GOLD_LATEST
from driftwell.session import configure, materialize, scratch
from driftwell.sources.tables import Tables

_LATENESS = f"{ALLOWED_LATENESS_SECONDS} seconds"


def gold_stream(silver: DataFrame) -> DataFrame:
    """Gold with state only for windows younger than the allowed lateness.

    The window is taken from the event time again, since the watermark has to reach the aggregate.
    """
    window = F.window("event_timestamp", f"{WINDOW_SECONDS} seconds")
    return (
        silver.withWatermark("event_timestamp", _LATENESS)
        .groupBy("device_id", window.alias("w"))
        .agg(*gold_metrics())
        .withColumn("window_start", F.col("w.start"))
        .withColumn("window_end", F.col("w.end"))
        .select(*GOLD.names)
    )


def start_gold(silver: DataFrame, tables: Tables, checkpoint: str, **trigger) -> StreamingQuery:
    """Final rows, one per device and window, written when the window can no longer change."""
    configure(silver.sparkSession)
    return (
        gold_stream(silver)
        .writeStream.queryName("gold")
        .outputMode("append")
        .foreachBatch(lambda rows, batch_id: tables.write(rows, "gold", batch_id))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def start_gold_updates(silver: DataFrame, tables: Tables, checkpoint: str, fold_every: int = FOLD_EVERY, **trigger) -> StreamingQuery:
    """Early and corrected rows: every batch writes the windows it changed, in full; now and then they are folded."""
    configure(silver.sparkSession)

    def write(rows: DataFrame, batch_id: int) -> None:
        if batch_id > 0 and batch_id % fold_every == 0:
            fold_gold_updates(tables, batch_id)
        tables.write(rows, "gold_updates", batch_id)

    return (
        gold_stream(silver)
        .writeStream.queryName("gold_updates")
        .outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def fold_gold_updates(tables: Tables, batch_id: int) -> None:
    """Between batches: updates of batches below ``batch_id`` become the newest version of their windows, kept by days.

    Only the days that have updates are rewritten, by dynamic partition overwrite, so the table follows the windows and not the
    updates. The updates are removed once the days are written; a fold that died in between is repeated, and until
    then readers see some versions twice, which ``latest_gold`` does not mind.
    """
    folded = [b for b in tables.batches("gold_updates") if b < batch_id]
    if not folded:
        return
    with scratch(tables.spark):
        fresh = _versions(tables.parts("gold_updates", folded))
        days = [r.day for r in fresh.select("day").distinct().collect()]
        both = materialize(_newest(_folded(tables).filter(F.col("day").isin(days)).unionByName(fresh)), "folded")
        writer = both.repartition("day", "device_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("day").parquet(tables.path("gold_latest"))
    for old in folded:
        tables.forget("gold_updates", old)


def latest_gold(tables: Tables) -> DataFrame:
    """The newest version of each device window among the updates."""
    return _newest(_folded(tables).unionByName(_versions(tables.read("gold_updates")))).select(*GOLD.names)


def _versions(updates: DataFrame) -> DataFrame:
    return updates.select(*GOLD.names, F.col("batch_id").alias("version"), F.to_date("window_start").alias("day"))


def _folded(tables: Tables) -> DataFrame:
    return tables.spark.read.schema(GOLD_LATEST).parquet(tables.path("gold_latest"))


def _newest(versions: DataFrame) -> DataFrame:
    row = F.struct(*[n for n in GOLD_LATEST.names if n not in ("device_id", "window_start")])
    return versions.groupBy("device_id", "window_start").agg(F.max_by(row, "version").alias("row")).select("device_id", "window_start", "row.*").select(*GOLD_LATEST.names)


def panes_stream(new_events: DataFrame, disorder_seconds: int = DISORDER_SECONDS) -> DataFrame:
    """The discarding view as it fires: a pane of the on-time rows once a window is over, and each late row as a pane.

    Whether a row is on time, late or dropped depends on its own arrival and window, so late panes need no state. On-time rows are
    aggregated until no more can come: an event is at most ``MAX_FUTURE_SECONDS`` ahead of its arrival, so a window that has been
    met ends at most that and a window's length after the newest arrival; arrivals may be out of order by ``disorder_seconds``.
    """
    reach = MAX_FUTURE_SECONDS + WINDOW_SECONDS + disorder_seconds
    classified = classify_lateness(new_events)
    on_time = classified.filter("lateness = 'on_time'").withWatermark("window_end", f"{reach} seconds")
    panes = on_time.groupBy("device_id", "window_start", "window_end").agg(*gold_metrics())
    panes = panes.select(*GOLD.names, F.lit("on_time").alias("pane"), F.lit(None).cast("string").alias("late_event_id"))
    return panes.unionByName(late_panes(classified))


def start_panes(new_events: DataFrame, tables: Tables, checkpoint: str, disorder_seconds: int = DISORDER_SECONDS, **trigger) -> StreamingQuery:
    configure(new_events.sparkSession)
    return (
        panes_stream(new_events, disorder_seconds)
        .writeStream.queryName("gold_panes")
        .outputMode("append")
        .foreachBatch(lambda rows, batch_id: tables.write(rows, "gold_panes", batch_id))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def arrival_counts_stream(records: DataFrame) -> DataFrame:
    """Rows per device and arrival minute; run it with ``processingTime="10 seconds"`` updates."""
    return device_arrival_counts(records.withWatermark("arrival_ts", "10 seconds"))


def start_arrival_counts(new_events: DataFrame, tables: Tables, checkpoint: str, **trigger) -> StreamingQuery:
    """Every batch writes its own counts per device and arrival minute; ``plans.debug.summed`` makes them whole.

    Nothing is remembered between batches, so no row is ever too late to count.
    """
    configure(new_events.sparkSession)
    return (
        new_events.writeStream.queryName("arrival_counts")
        .foreachBatch(lambda rows, batch_id: tables.write(device_arrival_counts(rows), "arrival_counts", batch_id))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )
