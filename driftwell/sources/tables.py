"""Append-only result tables: one Parquet partition per batch, written at most once.

Spark's dynamic partition overwrite commits a batch's partition: its files are written aside and the partition
appears as a whole when the job commits. So a reader (the gold stream, say) meets no file of an attempt that
failed, and a batch that is tried again keeps the partitions that are there and writes the others. A batch
without rows for a table leaves no partition.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from driftwell import schemas
from driftwell.config import REGISTRY_BUCKETS
from driftwell.plans.debug import DEBUG_TABLES
from driftwell.session import exists, folder_names, make_folder, remove
from driftwell.sources.registry import Registry

_MEMORY = StructType(
    [
        *[StructField(n, StringType()) for n in ("event_id", "memory", "remembered_hash")],
        *[StructField(n, TimestampType()) for n in ("remembered_at", "expires_at")],
    ]
)
_COUNTS = StructType(
    [
        StructField("minute", TimestampType()),
        StructField("minute_end", TimestampType()),
        StructField("stage", StringType()),
        StructField("route", StringType()),
        StructField("events", LongType()),
    ]
)
_LATENCY = StructType(
    [
        StructField("minute", TimestampType()),
        *[StructField(n, LongType()) for n in ("events", "sum_ms", "min_ms", "max_ms")],
        StructField("sketch", BinaryType()),
    ]
)
_MOMENT = [StructField("window_end", TimestampType())]
_FIRING = [StructField("firing", BooleanType())]


def _sums(*names: str) -> list[StructField]:
    return [StructField(n, LongType()) for n in names]


def _number(name: str) -> list[StructField]:
    return [StructField(name, DoubleType())]


_HELD = [StructField("breached", BooleanType()), *_FIRING]
ALERTS = {
    "stage_rates": StructType([*_MOMENT, *[StructField(n, StringType()) for n in ("stage", "route")], *_sums("events"), *_number("events_per_minute")]),
    "alert_invalid_rate": StructType([*_MOMENT, *_sums("valid_events", "invalid_events"), *_number("invalid_percent"), *_HELD]),
    "alert_conflict": StructType([*_MOMENT, *_sums("conflict_events")]),
    "alert_replay_rate": StructType([*_MOMENT, *_sums("replay_events", "decided_events"), *_number("replay_percent"), *_FIRING]),
    "alert_latency_p95": StructType([*_MOMENT, *_sums("events"), *_number("p95_ms"), *_HELD]),
}

SCHEMAS = {
    "raw_telemetry": schemas.TELEMETRY,
    "dead_letters": schemas.DEAD_LETTERS,
    "conflicts": schemas.CONFLICTS,
    "replays": schemas.REPLAYS,
    "registry_history": schemas.REGISTRY,
    "finished": StructType([StructField("finished_at", TimestampType())]),
    "batch_clock": StructType([StructField("batch_time", TimestampType())]),
    "short_term_memory": _MEMORY,
    "memory_parts": StructType([StructField("part", LongType()), StructField("until", TimestampType())]),
    "decided": schemas.DECIDED,
    "repairs": StructType([*schemas.DECIDED.fields, StructField("previous_route", StringType())]),
    "decided_again": StructType([StructField("event_id", StringType())]),
    "arrivals": StructType([StructField("source_partition", LongType()), StructField("last_arrival", TimestampType())]),
    "stage_counts": _COUNTS,
    "latency": _LATENCY,
    "batch_totals": StructType([*[StructField(n, StringType()) for n in ("stage", "route")], StructField("events", LongType())]),
    "batch_latency": StructType(_sums("events", "sum_ms", "min_ms", "max_ms")),
    **ALERTS,
    "new_events": schemas.NEW_EVENTS,
    "silver": schemas.SILVER,
    "gold": schemas.GOLD,
    "gold_updates": schemas.GOLD,
    "gold_latest": schemas.GOLD_LATEST,
    "gold_panes": schemas.PANES,
    "arrival_counts": schemas.ARRIVAL_COUNTS,
}


@dataclass
class Tables:
    spark: SparkSession
    root: str
    registry_buckets: int = REGISTRY_BUCKETS

    def create(self, debug: bool = False) -> Tables:
        for name in [*SCHEMAS, *(DEBUG_TABLES if debug else [])]:
            make_folder(self.spark, self.path(name))
        self.registry.create()
        return self

    @property
    def registry(self) -> Registry:
        return Registry(self.spark, self.path("registry"), self.registry_buckets)

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def _batch_path(self, name: str, batch_id: int) -> str:
        return f"{self.path(name)}/batch_id={batch_id}"

    def written(self, name: str, batch_id: int) -> bool:
        return exists(self.spark, self._batch_path(name, batch_id))

    def write(self, df: DataFrame, name: str, batch_id: int) -> None:
        """Append ``df`` as this batch's partition of an existing table, unless it is there already.

        Tables are not created on the fly.
        """
        if not exists(self.spark, self.path(name)):
            raise ValueError(f"table {name} does not exist under {self.root}")
        if name in SCHEMAS:
            df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS[name]])
        if self.written(name, batch_id):
            return
        numbered = df.withColumn("batch_id", F.lit(batch_id).cast("long"))
        writer = numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch_id").parquet(self.path(name))

    def batch_time(self, batch_id: int) -> datetime:
        """When the batch was first tried; its retries get the same."""
        self.write(self.spark.range(1).select(F.current_timestamp().alias("batch_time")), "batch_clock", batch_id)
        return self.part("batch_clock", batch_id).first().batch_time

    def part(self, name: str, batch_id: int) -> DataFrame:
        return self.parts(name, [batch_id]).drop("batch_id")

    def parts(self, name: str, batch_ids: list[int]) -> DataFrame:
        there = [self._batch_path(name, b) for b in batch_ids if self.written(name, b)]
        return self._read(name, *there) if there else self.read(name).limit(0)

    def rows(self, name: str, values: list[tuple]) -> DataFrame:
        return self.spark.createDataFrame(values, SCHEMAS[name])

    def keep(self, name: str, batch_ids: set[int]) -> None:
        """Removes all parts but these and later ones."""
        for old in self.batches(name):
            if old not in batch_ids and old < max(batch_ids):
                remove(self.spark, self._batch_path(name, old))

    def read(self, name: str) -> DataFrame:
        return self._read(name, self.path(name))

    def stream(self, name: str, files_per_batch: int = 1000) -> DataFrame:
        """The rows of a table as its batches are committed."""
        return self.spark.readStream.schema(SCHEMAS[name]).option("maxFilesPerTrigger", files_per_batch).parquet(self.path(name))

    def latest_before(self, name: str, batch_id: int) -> DataFrame | None:
        """The newest part older than this batch, for tables rewritten by every batch."""
        found = [b for b in self.batches(name) if b < batch_id]
        return self._read(name, self._batch_path(name, max(found))).drop("batch_id") if found else None

    def forget_before(self, name: str, batch_id: int) -> None:
        for old in self.batches(name):
            if old < batch_id:
                remove(self.spark, self._batch_path(name, old))

    def forget(self, name: str, batch_id: int) -> None:
        remove(self.spark, self._batch_path(name, batch_id))

    def batches(self, name: str) -> list[int]:
        names = folder_names(self.spark, self.path(name))
        return [int(n.split("=")[1]) for n in names if n.startswith("batch_id=")]

    def _read(self, name: str, *paths: str) -> DataFrame:
        schema = StructType([*SCHEMAS[name].fields, StructField("batch_id", LongType())])
        return self.spark.read.schema(schema).option("basePath", self.path(name)).parquet(*paths)
