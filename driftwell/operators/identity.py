"""Event identity: short-term conflicts, deduplication, and the durable new/replay/conflict decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwell.config import (
    CONFLICT_REASON,
    CONFLICT_TTL_SECONDS,
    DEDUPLICATION_SECONDS,
    FOLD_COPIES,
    HOT_ROWS,
    REPLAY_REASON,
    REQUIRED_FIELDS,
)
from driftwell.functions.times import plus_seconds
from driftwell.operators.admission import admit
from driftwell.operators.copies import (
    CONFLICT_MEMORY,
    DEDUP_MEMORY,
    REGISTRY_MEMORY,
    ROW_ID,
    Copies,
    find_copies,
    memory_rows,
    narrow_rows,
)
from driftwell.operators.salting import every_salt, row_salt
from driftwell.schemas import REGISTRY
from driftwell.session import materialize

SHORT_CONFLICT, DUPLICATE, NEW, REPLAY, CONFLICT = "short_conflict", "duplicate", "new", "replay", "conflict"


def classify(payload_hash: Column, registered_hash: Column) -> Column:
    """new, replay or conflict, from a record's hash and the hash registered for its id (or NULL)."""
    return (
        F.when(registered_hash.isNull(), F.lit(NEW))
        .when(payload_hash == registered_hash, F.lit(REPLAY))
        .when(payload_hash != registered_hash, F.lit(CONFLICT))
        .otherwise(F.raise_error(F.lit("record without payload_hash")))
    )


def classify_pairs(pairs: DataFrame) -> DataFrame:
    """The decision on rows that already carry ``registered_hash`` and ``registered_first_seen_at``."""
    return with_audit_columns(
        pairs.withColumn("route", classify(F.col("payload_hash"), F.col("registered_hash")))
    )


def with_audit_columns(routed: DataFrame) -> DataFrame:
    """Adds what the audit tables need, from ``route`` and the registered hash and time."""
    replayed = F.col("route") == REPLAY
    conflicting = F.col("route").isin(SHORT_CONFLICT, CONFLICT)
    return (
        routed.withColumn("replay_reason", F.when(replayed, F.lit(REPLAY_REASON)))
        .withColumn("original_first_seen_at", F.when(replayed, F.col("registered_first_seen_at")))
        .withColumn("conflict_reason", F.when(conflicting, F.lit(CONFLICT_REASON)))
        .withColumn("original_payload_hash", F.when(conflicting, F.col("registered_hash")))
        .withColumn("conflicting_payload_hash", F.when(conflicting, F.col("payload_hash")))
        .drop("registered_hash", "registered_first_seen_at")
    )


def with_conflict_expiry(rows: DataFrame) -> DataFrame:
    own = plus_seconds(F.col("arrival_ts"), CONFLICT_TTL_SECONDS)
    return rows.withColumn("expires_at", F.coalesce("expires_at", own))


def with_dedup_expiry(rows: DataFrame) -> DataFrame:
    own = plus_seconds(F.col("event_timestamp"), DEDUPLICATION_SECONDS)
    return rows.withColumn("expires_at", F.coalesce("expires_at", own))


def _of_stage(copies: Copies, memory: str) -> DataFrame:
    return copies.rows.filter(F.col("memory").isNull() | (F.col("memory") == memory))


def check_conflicts(copies: Copies, fold_copies: int = FOLD_COPIES) -> DataFrame:
    rows = with_conflict_expiry(_of_stage(copies, CONFLICT_MEMORY))
    return admit(rows, copies, fold_copies)


def check_duplicates(rows: DataFrame, copies: Copies, fold_copies: int = FOLD_COPIES) -> DataFrame:
    return admit(with_dedup_expiry(rows), copies, fold_copies)


def detect_conflicts(records: DataFrame, fold_copies: int = FOLD_COPIES, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Short-term conflicts: ``route`` is clean or conflict, with the audit columns on conflicts.

    Within the memory of an id's first payload, an equal hash is a clean duplicate and another hash
    is a conflict.
    """
    copies = find_copies(narrow_rows(records), hot_rows)
    checked = check_conflicts(copies, fold_copies)
    against = checked.filter(F.col("holder_hash") != F.col("payload_hash")).select(
        *ROW_ID, F.col("holder_hash").alias("registered_hash")
    )
    routed = (
        records.join(against, ROW_ID, "left")
        .withColumn("route", F.when(F.col("registered_hash").isNull(), "clean").otherwise(CONFLICT))
        .withColumn("registered_first_seen_at", F.lit(None).cast("timestamp"))
    )
    return with_audit_columns(routed).drop("replay_reason", "original_first_seen_at")


def deduplicate(records: DataFrame, fold_copies: int = FOLD_COPIES, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The first row per event id, and again after its event time is ten minutes past."""
    copies = find_copies(narrow_rows(records), hot_rows)
    checked = check_duplicates(copies.rows, copies, fold_copies)
    return records.join(checked.filter(~F.col("admitted")).select(*ROW_ID), ROW_ID, "left_anti")


def registry_hits(records: DataFrame, registry: DataFrame) -> DataFrame:
    """Registry rows of the ids at hand, as remembered rows, one for an id.

    A registry stored in buckets of the id (see ``sources.registry``) is neither shuffled nor gathered: the distinct
    ids of the batch are dealt to its buckets, or shipped if adaptive execution finds them small enough.
    """
    ids = records.select("event_id").distinct()
    # Of rows seen at one instant, the one registered last: a repair adds the row that came first after all.
    part = F.col("batch_id") if "batch_id" in registry.columns else F.lit(0)
    hits = registry.select("event_id", "payload_hash", "first_seen_at", (-part).alias("part")).join(ids, "event_id")
    first = hits.groupBy("event_id").agg(F.min(F.struct("first_seen_at", "part", "payload_hash")).alias("first"))
    return first.select(
        "event_id",
        F.lit(REGISTRY_MEMORY).alias("memory"),
        F.col("first.payload_hash").alias("remembered_hash"),
        F.col("first.first_seen_at").alias("remembered_at"),
        F.lit(None).cast("timestamp").alias("expires_at"),
    )


def decide_identity(
    records: DataFrame,
    registry: DataFrame | None = None,
    remembered: DataFrame | None = None,
    fold_copies: int = FOLD_COPIES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """All identity stages: every record with ``route`` short_conflict, duplicate, new, replay or conflict.

    ``registry`` holds what earlier batches registered; ``remembered`` the holders of the two
    short-term stages that were still alive (see ``short_term_memory``).
    """
    rows = narrow_rows(records)
    if registry is not None:
        rows = rows.unionByName(memory_rows(registry_hits(records, registry)))
    if remembered is not None:
        known = remembered.join(records.select("event_id").distinct(), "event_id")
        rows = rows.unionByName(memory_rows(newest_holders(known)))
    copies = find_copies(rows, hot_rows)
    verdicts = _verdicts(copies, fold_copies)
    own_dedup = plus_seconds(F.col("event_timestamp"), DEDUPLICATION_SECONDS) > F.col("arrival_ts")
    routed = (
        records.join(verdicts, ROW_ID, "left")
        .withColumn("route", F.coalesce("route", F.lit(NEW)))
        .withColumn("conflict_holder", F.coalesce("conflict_holder", F.lit(True)))
        .withColumn("dedup_holder", F.coalesce("dedup_holder", own_dedup))
    )
    return with_audit_columns(routed)


def _verdicts(copies: Copies, fold_copies: int) -> DataFrame:
    """Row id, ``route``, ``registered_hash`` and ``registered_first_seen_at`` of every copy."""
    checked = (
        check_conflicts(copies, fold_copies)
        .withColumn("conflicting", F.col("holder_hash") != F.col("payload_hash"))
        .withColumn("conflict_hash", F.when(F.col("conflicting"), F.col("holder_hash")))
        .withColumn("conflict_holder", F.col("admitted"))
        # A conflict takes no part in deduplication: expired on arrival, it holds nothing back.
        .withColumn("expires_at", F.when(F.col("conflicting"), F.col("arrival_ts")))
        .drop("holder_hash", "admitted")
    )
    if copies.most > fold_copies:
        checked = materialize(checked, "conflicts-checked")  # the distributed path reads it several times
    memory = copies.rows.filter(F.col("memory") == DEDUP_MEMORY)
    kept = materialize(
        check_duplicates(checked.unionByName(memory, allowMissingColumns=True), copies, fold_copies),
        "duplicates-checked",
    )
    stopped = kept.filter("conflicting OR NOT admitted").select(
        *ROW_ID,
        F.when(F.col("conflicting"), SHORT_CONFLICT).otherwise(DUPLICATE).alias("route"),
        F.col("conflict_hash").alias("registered_hash"),
        "conflict_holder",
        F.lit(False).alias("dedup_holder"),
    )
    registered = copies.rows.filter(F.col("memory") == REGISTRY_MEMORY)
    decided = _decide(kept.filter("admitted AND NOT conflicting"), registered)
    return stopped.unionByName(decided, allowMissingColumns=True)


def _decide(kept: DataFrame, registered: DataFrame) -> DataFrame:
    """Compare each kept row with the registered one, else with the first kept row of its id."""
    first = F.struct("arrival_ts", "arrival_seq", "payload_hash")
    candidates = kept.groupBy("event_id", "salts").agg(F.min(first).alias("first"))
    known = registered.select("event_id", "salts", "remembered_hash", "remembered_at")
    reference = candidates.join(known, ["event_id", "salts"], "left").select(
        "event_id",
        "first",
        "remembered_hash",
        "remembered_at",
        every_salt(),
    )
    holds = F.col("expires_at") > F.col("arrival_ts")
    rows = kept.select(
        *ROW_ID,
        "payload_hash",
        "conflict_holder",
        holds.alias("dedup_holder"),
        row_salt("arrival_ts", "arrival_seq"),
    )
    compared = rows.join(reference, ["event_id", "salt"])
    is_first = (F.col("arrival_ts") == F.col("first.arrival_ts")) & (F.col("arrival_seq") == F.col("first.arrival_seq"))
    unregistered = F.col("remembered_hash").isNull()
    registered_hash = F.when(~(unregistered & is_first), F.coalesce("remembered_hash", "first.payload_hash"))
    return compared.select(
        *ROW_ID,
        classify(F.col("payload_hash"), registered_hash).alias("route"),
        registered_hash.alias("registered_hash"),
        F.coalesce("remembered_at", "first.arrival_ts").alias("registered_first_seen_at"),
        "conflict_holder",
        "dedup_holder",
    )


def newest_holders(remembered: DataFrame) -> DataFrame:
    """One holder per id and stage: that of the last batch which made one."""
    if "batch_id" not in remembered.columns:
        return remembered
    holder = F.struct("remembered_hash", "remembered_at", "expires_at")
    newest = remembered.groupBy("event_id", "memory").agg(F.max_by(holder, "batch_id").alias("holder"))
    return newest.select("event_id", "memory", "holder.*")


def short_term_memory(routed: DataFrame) -> DataFrame:
    """The latest holder per id and stage that these rows made, for the ``remembered`` of later batches."""
    latest = F.max(F.struct("arrival_ts", "arrival_seq", "payload_hash", "expires_at")).alias("last")

    def last_holder(stage, holders):
        return holders.groupBy("event_id").agg(latest).select(
            "event_id",
            F.lit(stage).alias("memory"),
            F.col("last.payload_hash").alias("remembered_hash"),
            F.col("last.arrival_ts").alias("remembered_at"),
            F.col("last.expires_at").alias("expires_at"),
        )

    blank = routed.withColumn("expires_at", F.lit(None).cast("timestamp"))
    return last_holder(CONFLICT_MEMORY, with_conflict_expiry(blank.filter("conflict_holder"))).unionByName(
        last_holder(DEDUP_MEMORY, with_dedup_expiry(blank.filter("dedup_holder")))
    )


def registry_rows(new_rows: DataFrame) -> DataFrame:
    """What is registered for a new event; both times are its arrival, and stay so on replays."""
    return new_rows.select(
        "event_id",
        "device_id",
        "event_timestamp",
        "payload_hash",
        F.col("arrival_ts").alias("first_seen_at"),
        F.col("arrival_ts").alias("last_seen_at"),
    ).select(*REGISTRY.names)


def replay_audit_rows(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("route") == REPLAY).select(
        "event_id",
        "device_id",
        "event_timestamp",
        "payload_hash",
        "replay_reason",
        "original_first_seen_at",
        F.col("arrival_ts").alias("replay_detected_at"),
    )


def short_conflict_audit_rows(conflicts: DataFrame, *others: str) -> DataFrame:
    return conflicts.select(
        *others,
        *REQUIRED_FIELDS,
        "payload_hash",
        "original_payload_hash",
        "conflicting_payload_hash",
        "conflict_reason",
        F.col("arrival_ts").alias("conflict_detected_at"),
    )


def durable_conflict_audit_rows(conflicts: DataFrame) -> DataFrame:
    return conflicts.select(
        "event_id",
        "device_id",
        "event_timestamp",
        "conflict_reason",
        "original_payload_hash",
        "conflicting_payload_hash",
    )


def conflict_audit_rows(routed: DataFrame) -> DataFrame:
    """Both producers in the one audit table, in one pass; the durable one leaves its missing columns NULL."""
    both = routed.filter(F.col("route").isin(SHORT_CONFLICT, CONFLICT))
    audited = short_conflict_audit_rows(both.select("*", F.col("route").alias("producer")), "producer")
    shared = durable_conflict_audit_rows(both).columns
    short = F.col("producer") == SHORT_CONFLICT
    return audited.select(*[F.col(c) if c in shared else F.when(short, F.col(c)).alias(c) for c in audited.columns if c != "producer"])
