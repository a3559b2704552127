"""What the two ten-minute stages remember between batches: one part per batch, never rewritten.

A holder may be forgotten once no row can arrive any more that it outlives. How far arrivals have come is
tracked per source partition, and the partition furthest behind decides, so one that runs ahead (or an
odd clock) does not make the others forget. Within a partition, arrivals may be out of order by
``disorder_seconds``; a partition silent for ``IDLE_SECONDS`` of arrivals no longer holds the rest back.
Rows behind the horizon are processed like any other, counted as ``arrival`` / ``behind``, and their ids decided
again (see ``repair``); holders of such an id from before that are not remembered.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwell.config import DISORDER_SECONDS, IDLE_SECONDS, SOURCE_PARTITION_BITS
from driftwell.sources.tables import Tables

MEMORY, PARTS, PROGRESS, AGAIN = "short_term_memory", "memory_parts", "arrivals", "decided_again"


def source_partition() -> Column:
    return F.shiftright("arrival_seq", SOURCE_PARTITION_BITS)


def latest_arrivals(records: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """``source_partition, last_arrival``: how far each partition has come; one row per partition."""
    found = records.select("source_partition", F.col("arrival_ts").alias("last_arrival"))
    both = found if earlier is None else found.unionByName(earlier)
    return both.groupBy("source_partition").agg(F.max("last_arrival").alias("last_arrival"))


def horizon(progress: DataFrame, disorder_seconds: int = DISORDER_SECONDS) -> datetime | None:
    """No row is expected to arrive before this instant; NULL before the first row."""
    furthest = progress.agg(F.max("last_arrival")).first()[0]
    if furthest is None:
        return None
    active = progress.filter(F.col("last_arrival") >= F.lit(furthest - timedelta(seconds=IDLE_SECONDS)))
    return active.agg(F.min("last_arrival")).first()[0] - timedelta(seconds=disorder_seconds)


class ShortTermMemory:
    """The memory as batch ``batch_id`` finds it, and what the batch adds."""

    def __init__(self, tables: Tables, batch_id: int, disorder_seconds: int = DISORDER_SECONDS):
        self.tables, self.batch_id, self.disorder_seconds = tables, batch_id, disorder_seconds
        self.progress = tables.latest_before(PROGRESS, batch_id)
        self.horizon = None if self.progress is None else horizon(self.progress, disorder_seconds)
        parts = tables.latest_before(PARTS, batch_id)
        # One row per part that is still alive: as many as batches fit into the disorder and the ten minutes.
        self.parts = [] if parts is None else [(r.part, r.until) for r in parts.collect() if r.until is not None]

    def remembered(self) -> DataFrame | None:
        if not self.parts:
            return None
        oldest = min(part for part, _ in self.parts)
        found = self.tables.parts(MEMORY, [part for part, _ in self.parts])
        if not any(oldest < b < self.batch_id for b in self.tables.batches(AGAIN)):
            return found
        again = self.tables.read(AGAIN).filter((F.col("batch_id") > oldest) & (F.col("batch_id") < self.batch_id))
        since = again.groupBy("event_id").agg(F.max("batch_id").alias("since"))
        return found.join(since, "event_id", "left").filter("since IS NULL OR batch_id >= since").drop("since")

    def is_behind(self) -> Column:
        return F.lit(False) if self.horizon is None else F.col("arrival_ts") < F.lit(self.horizon)

    def behind(self, records: DataFrame) -> DataFrame:
        """``arrival_ts, stage, route`` of rows that arrive later than the memory reaches back."""
        return records.filter(self.is_behind()).select("arrival_ts", F.lit("arrival").alias("stage"), F.lit("behind").alias("route"))

    def advance(self, records: DataFrame, holders: DataFrame):
        """The tables that carry the memory on; ``holders`` are those the batch itself made."""
        yield MEMORY, holders
        yield PROGRESS, latest_arrivals(records.withColumn("source_partition", source_partition()), self.progress)
        reached = horizon(self.tables.part(PROGRESS, self.batch_id), self.disorder_seconds)
        until = self.tables.part(MEMORY, self.batch_id).agg(F.max("expires_at")).first()[0]
        # The batch's own row is there even if it remembers nothing, so that the list is never taken from an older one.
        alive = [(part, last) for part, last in self.parts if reached is None or last > reached]
        own = until if until is not None and (reached is None or until > reached) else None
        yield PARTS, self.tables.rows(PARTS, [*alive, (self.batch_id, own)])

    def forget(self) -> None:
        """Removes parts that no longer matter; only once the batch is done."""
        alive = {r.part for r in self.tables.part(PARTS, self.batch_id).collect()}
        self.tables.keep(MEMORY, alive | {self.batch_id})
        for name in (PARTS, PROGRESS):
            self.tables.forget_before(name, self.batch_id)
        self.tables.forget_before(AGAIN, min(alive))
