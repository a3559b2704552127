"""The rows whose event id occurs more than once: the only ones identity has to look at.

An id seen once is clean, first and kept. So the stages that compare copies run on a narrow table
of the repeated ids, and their verdicts go back to the full rows by the unique row id
``(event_id, arrival_ts, arrival_seq)``, which spreads evenly however hot an id is.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwell.config import HOT_ROWS
from driftwell.operators.salting import every_salt, row_salt, salts_for
from driftwell.session import materialize

ROW_ID = ["event_id", "arrival_ts", "arrival_seq"]
NARROW = [*ROW_ID, "event_timestamp", "payload_hash"]

# Rows remembered from earlier batches travel with the copies, told apart by ``memory``.
MEMORY_COLUMNS = ["memory", "remembered_hash", "remembered_at", "expires_at"]
CONFLICT_MEMORY, DEDUP_MEMORY, REGISTRY_MEMORY = "conflict", "dedup", "registry"


@dataclass
class Copies:
    """Narrow rows of repeated ids with ``copies`` and ``salts``; the largest count; the size of a salt."""

    rows: DataFrame
    most: int
    hot_rows: int


def narrow_rows(records: DataFrame) -> DataFrame:
    return records.select(
        *NARROW,
        F.lit(None).cast("string").alias("memory"),
        F.lit(None).cast("string").alias("remembered_hash"),
        F.lit(None).cast("timestamp").alias("remembered_at"),
        F.lit(None).cast("timestamp").alias("expires_at"),
    )


def memory_rows(remembered: DataFrame) -> DataFrame:
    """``event_id, memory, remembered_hash, remembered_at, expires_at`` in the narrow layout."""
    return remembered.select(
        "event_id",
        F.lit(None).cast("timestamp").alias("arrival_ts"),
        F.lit(None).cast("long").alias("arrival_seq"),
        F.lit(None).cast("timestamp").alias("event_timestamp"),
        F.lit(None).cast("string").alias("payload_hash"),
        *MEMORY_COLUMNS,
    )


def find_copies(rows: DataFrame, hot_rows: int = HOT_ROWS) -> Copies:
    """Count each id with a mergeable aggregate, then keep the rows of repeated ids."""
    counted = rows.groupBy("event_id").agg(F.count("*").alias("copies")).filter("copies > 1")
    repeated = materialize(counted, "repeated-ids")
    most, total = repeated.agg(F.max("copies"), F.sum("copies")).first()
    if most is None:
        most, total = 0, 0
    # At most 10,000 ids can reach this size, so the list of hot ids stays small enough to ship.
    hot_rows = max(hot_rows, total // 10_000)
    repeated = repeated.withColumn("salts", salts_for(F.col("copies"), hot_rows))
    if most <= hot_rows:
        found = rows.join(repeated, "event_id")
    else:
        hot = F.broadcast(repeated.filter(F.col("salts") > 1).select("event_id", "salts"))
        salted = (
            rows.join(hot, "event_id", "left")
            .withColumn("salts", F.coalesce("salts", F.lit(1)))
            .withColumn("salt", row_salt("arrival_ts", "arrival_seq"))
            .drop("salts")
        )
        found = salted.join(repeated.select("*", every_salt()), ["event_id", "salt"]).drop("salt")
    copies = materialize(found, "copies")
    twice = copies.filter("memory IS NULL").groupBy(*ROW_ID).count().filter("count > 1")
    if not twice.isEmpty():
        raise ValueError(f"({', '.join(ROW_ID)}) is not unique: verdicts could not be told apart")
    return Copies(copies, most, hot_rows)
