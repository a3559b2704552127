"""Registered queries: one per operator, each over the whole ``events`` table."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from driftwell.config import LATENCY_RANK_ERROR, RATE_WINDOW_MINUTES, REQUIRED_FIELDS
from driftwell.operators import dead_letters as letters
from driftwell.operators import gold as gold_ops
from driftwell.operators import identity, quality, windows
from driftwell.operators.parse import parse_messages
from driftwell.operators.validate import validate
from driftwell.plans.flow import TelemetryFlow, message_routes
from driftwell.session import configure, materialize, shared_dir
from driftwell.sources import events, streams
from driftwell.sources.registry import Registry
from driftwell.streaming import memory


def flow(spark: SparkSession, sf_dir: str) -> TelemetryFlow:
    configure(spark)
    table = events.events_table(spark, sf_dir)
    made = TelemetryFlow(events.messages(table), as_of=events.as_of())
    made.events = table
    return made


def _plain(df: DataFrame) -> DataFrame:
    """Instants as zone-less UTC timestamps, so that other engines read the same values."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType) else F.col(f.name)
            for f in df.schema
        ]
    )


_REGISTERED: dict[str, Callable[[TelemetryFlow], DataFrame]] = {}


def _query(function):
    _REGISTERED[function.__name__] = function
    return function


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(function):
        return lambda spark, sf_dir: _plain(function(flow(spark, sf_dir)))

    return {name: runner(function) for name, function in _REGISTERED.items()}


# -- parsing and validation ----------------------------------------------------------------------


@_query
def parsed_valid(f):
    return f.parsed.filter(F.col("route") == "valid").select("arrival_seq", "arrival_ts", "message")


@_query
def parser_dlq(f):
    return f.parser_letters


@_query
def validated(f):
    return f.validated.select("arrival_seq", "route", F.size("errors").cast("long").alias("error_count"))


@_query
def validation_errors(f):
    rejected = f.validated.filter(F.col("route") == "invalid")
    numbered = rejected.select("arrival_seq", F.posexplode("errors").alias("position", "error"))
    return numbered.select("arrival_seq", F.col("position").cast("long").alias("position"), "error")


@_query
def validator_dlq(f):
    return f.validator_letters.withColumn("errors", F.to_json("errors"))


@_query
def dlq_messages(f):
    return f.dead_letters


@_query
def dlq_by_stage(f):
    return f.letters_by_stage.groupBy("error_stage").agg(F.count("*").alias("letters"))


@_query
def dlq_union(f):
    """Both kinds of letters made apart and put together again."""
    return letters.dead_letters(f.parser_letters, f.validator_letters)


@_query
def raw_telemetry(f):
    return f.telemetry.select(*REQUIRED_FIELDS)


@_query
def event_time_assigned(f):
    timed = windows.assign_event_time(f.telemetry)
    return timed.select("event_id", "device_id", "event_timestamp", "event_time")


@_query
def event_window_rows(f):
    return windows.event_time_rows(windows.assign_window(f.telemetry))


@_query
def fingerprinted(f):
    return f.fingerprinted.select("event_id", "arrival_seq", "payload_hash")


# -- identity ------------------------------------------------------------------------------------


@_query
def conflicts_short(f):
    conflicts = f.conflict_checked.filter(F.col("route") == "conflict")
    return identity.short_conflict_audit_rows(conflicts)


@_query
def clean(f):
    return f.clean.select("event_id", "arrival_seq", "payload_hash")


@_query
def deduplicated(f):
    return identity.deduplicate(f.clean).select("event_id", "arrival_seq", "payload_hash")


@_query
def identity_routes(f):
    return f.routed.select("event_id", "arrival_seq", "route")


@_query
def identity_new(f):
    return f.new.select(*REQUIRED_FIELDS, "payload_hash")


@_query
def identity_replay(f):
    return f.routed.filter(F.col("route") == identity.REPLAY).select(
        *REQUIRED_FIELDS, "payload_hash", "replay_reason", "original_first_seen_at"
    )


@_query
def identity_conflict(f):
    return f.routed.filter(F.col("route") == identity.CONFLICT).select(
        *REQUIRED_FIELDS, "conflict_reason", "original_payload_hash", "conflicting_payload_hash"
    )


@_query
def identity_in_two_batches(f):
    """The first half of the arrivals, then the second with what the first one left behind."""
    rows = f.accepted
    bounds = rows.agg(F.min("arrival_ts").alias("low"), F.max("arrival_ts").alias("high"))
    low, high = bounds.select(F.unix_micros("low"), F.unix_micros("high")).first()
    cut = F.timestamp_micros(F.lit((low + high) // 2))
    first = identity.decide_identity(rows.filter(F.col("arrival_ts") < cut))
    registry = identity.registry_rows(first.filter(F.col("route") == identity.NEW))
    remembered = identity.short_term_memory(first)
    second = identity.decide_identity(rows.filter(F.col("arrival_ts") >= cut), registry, remembered)
    return first.unionByName(second).select("event_id", "arrival_seq", "route", "original_first_seen_at")


@_query
def identity_in_device_batches(f):
    """Three batches whose arrivals overlap in time: every device is cut at instants of its own.

    A later batch finds only the parts of the memory that outlive the horizon, which the device
    furthest behind decides.
    """
    device = F.pmod(F.xxhash64("device_id"), F.lit(16))
    rows = f.accepted
    bounds = rows.agg(F.min("arrival_ts").alias("low"), F.max("arrival_ts").alias("high"))
    low, high = bounds.select(F.unix_micros("low"), F.unix_micros("high")).first()
    come = (F.unix_micros("arrival_ts") - F.lit(low)) / F.lit(max(high - low, 1))
    batch = F.when(come < (device + 1) / 40, 0).when(come < (device + 21) / 40, 1).otherwise(2)
    numbered = rows.withColumn("batch", batch)
    results, registry, remembered, progress = [], None, None, None
    for number in range(3):
        records = numbered.filter(F.col("batch") == number).drop("batch")
        routed = materialize(identity.decide_identity(records, registry, remembered), f"batch-{number}")
        results.append(routed.select("event_id", "arrival_seq", "route", "original_first_seen_at"))
        new = identity.registry_rows(routed.filter(F.col("route") == identity.NEW))
        registry = new if registry is None else registry.unionByName(new)
        partitioned = records.withColumn("source_partition", device)
        progress = memory.latest_arrivals(partitioned, progress)
        part = identity.short_term_memory(routed).withColumn("batch_id", F.lit(number).cast("long"))
        known = part if remembered is None else remembered.unionByName(part)
        reached = memory.horizon(progress, disorder_seconds=0)
        remembered = known if reached is None else known.filter(F.col("expires_at") > F.lit(reached))
    return results[0].unionByName(results[1]).unionByName(results[2])


@_query
def identity_in_stored_batches(f):
    """Four batches by arrival against the stored registry, whose parts are merged on the way."""
    rows = f.accepted
    spark = rows.sparkSession
    low, high = rows.agg(F.min(F.unix_micros("arrival_ts")), F.max(F.unix_micros("arrival_ts"))).first()
    part = F.floor((F.unix_micros("arrival_ts") - F.lit(low)) * 4 / F.lit(high - low + 1))
    stored = Registry(spark, f"{shared_dir(spark)}/driftwell/tables/registry-{uuid.uuid4().hex}", buckets=16, fan=2)
    results, remembered = [], None
    for number in range(4):
        stored.create().merge(number)
        routed = identity.decide_identity(rows.filter(part == number), stored.before(number), remembered)
        routed = materialize(routed, f"batch-{number}")
        stored.add(identity.registry_rows(routed.filter(F.col("route") == identity.NEW)), number)
        holders = identity.short_term_memory(routed).withColumn("batch_id", F.lit(number).cast("long"))
        remembered = holders if remembered is None else remembered.unionByName(holders)
        results.append(routed.select("event_id", "arrival_seq", "route", "original_first_seen_at"))
    return reduce(DataFrame.unionByName, results)


@_query
def registry_pairs(f):
    """Every record paired with the registry row of its id seen earlier, if any, and classified.

    The registry is unique by id. The rows of a hot id are split by adaptive execution, which may cut
    the left side of a left join, since nothing after the join needs them together.
    """
    registry = identity.registry_rows(f.new).select(
        F.col("event_id").alias("registered_id"),
        F.col("payload_hash").alias("registered_hash"),
        F.col("first_seen_at").alias("registered_first_seen_at"),
    )
    seen_before = (F.col("event_id") == F.col("registered_id")) & (
        F.col("registered_first_seen_at") < F.col("arrival_ts")
    )
    pairs = f.accepted.join(registry, seen_before, "left").drop("registered_id")
    return identity.classify_pairs(pairs).select(
        "event_id", "arrival_seq", "route", "replay_reason", "original_first_seen_at", "original_payload_hash"
    )


@_query
def replay_audit(f):
    return identity.replay_audit_rows(f.routed)


@_query
def conflict_audit(f):
    return identity.conflict_audit_rows(f.routed)


@_query
def event_registry(f):
    return identity.registry_rows(f.new)


# -- windows and aggregates ----------------------------------------------------------------------


@_query
def window_assignment(f):
    return windows.assign_window(f.telemetry).select("event_id", "arrival_seq", "window_start", "window_end")


@_query
def lateness_class(f):
    return windows.classify_lateness(f.windowed).select("event_id", "window_end", "lateness")


@_query
def silver(f):
    return windows.silver_rows(f.windowed)


@_query
def gold_input(f):
    return windows.gold_input_rows(f.windowed)


@_query
def gold(f):
    return gold_ops.gold(f.windowed)


@_query
def gold_panes(f):
    return gold_ops.gold_panes(windows.classify_lateness(f.windowed))


@_query
def device_window_counts(f):
    return gold_ops.device_window_counts(windows.assign_window(f.telemetry))


@_query
def new_device_window_counts(f):
    return gold_ops.device_window_counts(f.windowed)


@_query
def device_arrival_counts(f):
    return gold_ops.device_arrival_counts(f.telemetry)


@_query
def new_device_arrival_counts(f):
    return gold_ops.device_arrival_counts(f.new)


# -- quality -------------------------------------------------------------------------------------


@_query
def latency_stats(f):
    return quality.latency_stats(quality.measure_latency(f.telemetry))


@_query
def latency_totals(f):
    return quality.measure_latency(f.telemetry).agg(
        F.count("latency_ms").alias("events"),
        F.sum("latency_ms").alias("sum_ms"),
        F.min("latency_ms").alias("min_ms"),
        F.max("latency_ms").alias("max_ms"),
    )


@_query
def stage_counts(f):
    return f.stage_counts


@_query
def stage_totals(f):
    return f.stage_counts.groupBy("stage", "route").agg(F.sum("events").alias("events"))


@_query
def stage_rate_5m(f):
    return quality.stage_rates(f.stage_counts)


@_query
def alert_invalid_rate(f):
    alert = quality.invalid_rate_alert(quality.stage_counts(message_routes(f.checked)))
    return alert.withColumn("invalid_percent", F.round("invalid_percent", 6))


@_query
def alert_conflict(f):
    checks = f.conflict_checked.select("arrival_ts", F.lit("conflict_check").alias("stage"), "route")
    return quality.conflict_alert(quality.stage_counts(checks))


@_query
def alert_replay_rate(f):
    alert = quality.replay_rate_alert(f.stage_counts)
    return alert.withColumn("replay_percent", F.round("replay_percent", 6))


@_query
def alert_latency_p95(f):
    alert = quality.latency_p95_alert(quality.measure_latency(f.telemetry))
    return alert.withColumn("p95_ms", F.round("p95_ms", 3))


@_query
def latency_p95_stored(f):
    """Five-minute P95 from stored sketches of several batches: whether each is within the stated error in ranks."""
    measured = quality.measure_latency(f.telemetry)
    batches = [quality.latency_rollup(measured.filter(F.pmod(F.xxhash64("arrival_seq"), F.lit(3)) == n)) for n in range(3)]
    stored = materialize(reduce(DataFrame.unionByName, batches), "latency")
    p95 = quality.latency_p95_windows(stored).select("window_end", "p95_ms")
    rows = measured.select(F.window("arrival_ts", f"{RATE_WINDOW_MINUTES} minutes").end.alias("window_end"), "latency_ms")
    counted = rows.groupBy("window_end", "latency_ms").agg(F.count("*").alias("n")).join(p95, "window_end")
    shares = counted.groupBy("window_end").agg(
        F.sum("n").alias("events"),
        (F.sum(F.when(F.col("latency_ms") < F.col("p95_ms"), F.col("n")).otherwise(0)) / F.sum("n")).alias("below"),
        (F.sum(F.when(F.col("latency_ms") <= F.col("p95_ms"), F.col("n")).otherwise(0)) / F.sum("n")).alias("upto"),
    )
    within = (F.col("below") <= 0.95 + LATENCY_RANK_ERROR) & (F.col("upto") >= 0.95 - LATENCY_RANK_ERROR)
    return shares.select("window_end", "events", within.alias("within_error"))


# -- rows at the edges of the rules, which the regular messages do not have ------------------------


@_query
def edge_validation(f):
    """Ids of 100 and 101 characters, blank ids and bytes that are no text, one kind a message."""
    checked = validate(parse_messages(events.edge_messages(f.events)), f.as_of)
    return checked.select("arrival_seq", "route", F.array_join("errors", "; ").alias("errors"))


@_query
def edge_decoding(f):
    """Messages as text: what is no UTF-8 becomes the replacement character."""
    decoded = parse_messages(events.edge_messages(f.events))
    return decoded.select("arrival_seq", F.sha2(F.col("message"), 256).alias("message_sha256"), F.length("message").cast("long").alias("n_chars"))


@_query
def file_identity(f):
    """Every message names itself by its file and row there: as many names as messages, in however many files."""
    spark = f.events.sparkSession
    path = f"{shared_dir(spark)}/driftwell/tables/inbox-{uuid.uuid4().hex}"
    f.messages.select("value").write.parquet(path)
    named, again = (streams.file_identity(spark.read.schema("value binary").parquet(path).select("value", "_metadata")) for _ in range(2))
    both = named.join(again.select("arrival_seq", F.col("value").alias("other")), "arrival_seq", "left")
    return both.agg(F.count("*").alias("messages"), F.count_distinct("arrival_seq").alias("names"), F.count_if(F.col("value") == F.col("other")).alias("same_again"))
