"""Message streams: ``value`` bytes with ``arrival_ts`` and a unique ``arrival_seq``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwell.config import SOURCE_PARTITION_BITS
from driftwell.schemas import MESSAGES, NEW_EVENTS, SILVER


def file_messages(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Parquet files in the message layout, as they appear in a folder."""
    return spark.readStream.schema(MESSAGES).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def file_bytes(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Parquet files of nothing but ``value`` bytes, as they appear in a folder.

    A message arrives when its file was last changed, and is named by its file and its place in it: equal files under two
    names hold different messages, and a batch that is tried again names them alike.
    """
    rows = spark.readStream.schema("value binary").option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return file_identity(rows.select("value", "_metadata"))


def file_identity(rows: DataFrame) -> DataFrame:
    """``value, arrival_ts, arrival_seq`` from ``value`` and the files' ``_metadata``, batch or stream.

    The file's source partition (above ``SOURCE_PARTITION_BITS``) and 12 more bits are a hash of its path; 32 bits count its rows.
    """
    number = F.xxhash64("_metadata.file_path")
    partition = F.pmod(number, F.lit(1 << (63 - SOURCE_PARTITION_BITS)))
    more = F.pmod(F.shiftrightunsigned(number, 32), F.lit(1 << (SOURCE_PARTITION_BITS - 32)))
    name = partition * F.lit(1 << SOURCE_PARTITION_BITS) + more * F.lit(1 << 32) + F.col("_metadata.row_index")
    return rows.select("value", F.col("_metadata.file_modification_time").alias("arrival_ts"), name.alias("arrival_seq"))


def new_event_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    rows = spark.readStream.schema(NEW_EVENTS).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return rows.select(*NEW_EVENTS.names)


def kafka_messages(
    spark: SparkSession, servers: str, topic: str, offsets_per_batch: int = 50_000_000
) -> DataFrame:
    """A Kafka topic (needs the Kafka connector on the class path).

    Only a time the broker stamped (``timestampType`` 1) is an arrival; a producer's own is not trusted, and
    the ingest stamps those messages with the time of their batch.
    """
    stream = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", offsets_per_batch)
        .load()
    )
    # Offsets are unique per partition; the partition number goes above them.
    sequence = F.col("partition").cast("long") * F.lit(2**SOURCE_PARTITION_BITS) + F.col("offset")
    return stream.select("value", broker_time().alias("arrival_ts"), sequence.alias("arrival_seq"))


def broker_time() -> Column:
    return F.when(F.col("timestampType") == 1, F.col("timestamp"))


def silver_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    rows = spark.readStream.schema(SILVER).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return rows.select(*SILVER.names)


def dead_letters_to_kafka(servers: str, topic: str):
    """A ``send_dead_letters`` for ``process_batch`` and ``start_ingest``."""

    def send(letters: DataFrame) -> None:
        writer = letters.select("value").write.format("kafka")
        writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()

    return send
