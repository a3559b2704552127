"""The durable registry of event ids: a Spark table in buckets of the id, with a part for each batch.

Rows of an id are in the same bucket in every part, so a lookup joins bucket by bucket: only the ids of the
batch are shuffled, the registry is read where it lies. Parts are put together in levels: ``fan`` parts of a
level become one of the next, bucket by bucket and without a shuffle, so that a row is rewritten a logarithmic
number of times and a bucket is never in many files.

Each part is written by Spark's dynamic partition overwrite: it appears whole, and a batch that is tried again
replaces its own part. A merged part is complete before the parts it stands for are removed; a job that dies in
between leaves rows twice, which no lookup can tell from once, since a row of an id is always the same.
"""

from __future__ import annotations

import hashlib
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwell.config import REGISTRY_BUCKETS, REGISTRY_FAN
from driftwell.schemas import REGISTRY
from driftwell.session import exists, folder_names, make_folder, remove

@contextmanager
def _setting(spark: SparkSession, name: str, value: str):
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


class Registry:
    """``path`` is a folder that all executors reach. The table's name is made from it."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = REGISTRY_BUCKETS, fan: int = REGISTRY_FAN):
        self.spark, self.path, self.buckets, self.fan = spark, path.rstrip("/"), buckets, fan
        self.table = f"driftwell_registry_{hashlib.md5(self.path.encode()).hexdigest()[:16]}"

    def create(self) -> Registry:
        """Makes the table known to this session; parts that are there already stay.

        Its partitions are found by listing the folder, so a new driver needs no catalog that outlives it.
        """
        make_folder(self.spark, self.path)
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in REGISTRY)
        with _setting(self.spark, "spark.sql.hive.manageFilesourcePartitions", "false"):
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.table} ({columns}, level INT, batch_id BIGINT) USING parquet PARTITIONED BY (level, batch_id) "
                f"CLUSTERED BY (event_id) SORTED BY (event_id) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
            )
        return self

    def rows(self) -> DataFrame:
        """All rows with ``level`` and ``batch_id``. A row may be there twice after a merge that was cut short."""
        self.create().spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def before(self, batch_id: int) -> DataFrame:
        """What earlier batches registered; rows of the batch itself, from a failed attempt, are left out."""
        return self.rows().filter(F.col("batch_id") < batch_id)

    def add(self, registered: DataFrame, batch_id: int) -> None:
        """The batch's part, in place of one it may have written before."""
        self._write(registered, 0, batch_id)

    def merge(self, batch_id: int) -> None:
        """Between batches: put the parts of each full level below ``batch_id`` together."""
        level = 0
        while level <= max(self._numbers(self.path, "level"), default=-1):
            ready = [b for b in self.parts(level) if b < batch_id]
            if len(ready) >= self.fan:
                self._write(self._level_rows(level, max(ready)), level + 1, max(ready))
                for part in ready:
                    remove(self.spark, f"{self.path}/level={level}/batch_id={part}")
            level += 1

    def parts(self, level: int) -> list[int]:
        """The last batch of each part of a level."""
        folder = f"{self.path}/level={level}"
        return sorted(self._numbers(folder, "batch_id")) if exists(self.spark, folder) else []

    def _numbers(self, folder: str, key: str) -> list[int]:
        return [int(n.split("=")[1]) for n in folder_names(self.spark, folder) if n.startswith(f"{key}=")]

    def _level_rows(self, level: int, last: int) -> DataFrame:
        """Rows of a level up to a batch, each id once; grouped by the id, so that Spark reads and writes by buckets."""
        rows = self.rows().filter((F.col("level") == level) & (F.col("batch_id") <= last))
        others = [n for n in REGISTRY.names if n not in ("event_id", "first_seen_at")]
        ordered = F.struct("first_seen_at", (-F.col("batch_id")).alias("part"), *others)
        first = rows.groupBy("event_id").agg(F.min(ordered).alias("first"))
        return first.select("event_id", *[F.col(f"first.{n}").alias(n) for n in ("first_seen_at", *others)])

    def _write(self, rows: DataFrame, level: int, batch_id: int) -> None:
        self.create()
        placed = rows.select(*REGISTRY.names, F.lit(level).alias("level"), F.lit(batch_id).cast("long").alias("batch_id"))
        if level == 0:  # a file for each bucket, not one for each bucket and task
            placed = placed.repartition(self.buckets, "event_id")
        # The rows' own session writes them, which in a stream's batch is another one; without the setting all parts would go.
        with _setting(placed.sparkSession, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            placed.write.insertInto(self.table, overwrite=True)
