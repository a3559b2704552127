"""Table schemas. Nothing is inferred."""

from pyspark.sql.types import (
    BinaryType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from driftwell.config import SENSORS


def _fields(type_, *names, nullable=True):
    return [StructField(n, type_, nullable) for n in names]


_SENSOR_FIELDS = _fields(DoubleType(), *SENSORS)
_WINDOW_FIELDS = _fields(TimestampType(), "window_start", "window_end")
_IDENTITY_FIELDS = [
    *_fields(StringType(), "event_id", "device_id"),
    *_fields(TimestampType(), "event_timestamp"),
]

MESSAGES = StructType(
    [
        *_fields(BinaryType(), "value"),
        *_fields(TimestampType(), "arrival_ts"),
        *_fields(LongType(), "arrival_seq"),
    ]
)

TELEMETRY = StructType([*_IDENTITY_FIELDS, *_SENSOR_FIELDS])

SILVER = StructType([*TELEMETRY.fields, *_WINDOW_FIELDS])

GOLD = StructType(
    [
        *_fields(StringType(), "device_id"),
        *_WINDOW_FIELDS,
        *_fields(LongType(), "event_count"),
        *_fields(
            DoubleType(),
            "avg_temperature",
            "min_temperature",
            "max_temperature",
            "avg_humidity",
            "avg_pressure",
            "avg_battery_level",
        ),
    ]
)

# New events on the arrival clock, for what depends on how late a row is.
NEW_EVENTS = StructType([*SILVER.fields, *_fields(TimestampType(), "arrival_ts"), *_fields(LongType(), "arrival_seq")])

# The newest version of each window among the updates that were folded; ``version`` is the batch that made it.
GOLD_LATEST = StructType([*GOLD.fields, *_fields(LongType(), "version"), *_fields(DateType(), "day")])

ARRIVAL_COUNTS = StructType([*_fields(StringType(), "device_id"), *_WINDOW_FIELDS, *_fields(LongType(), "record_count")])

PANES = StructType([*GOLD.fields, *_fields(StringType(), "pane", "late_event_id")])

CONFLICTS = StructType(
    [
        *TELEMETRY.fields,
        *_fields(
            StringType(),
            "payload_hash",
            "original_payload_hash",
            "conflicting_payload_hash",
            "conflict_reason",
        ),
        *_fields(TimestampType(), "conflict_detected_at"),
    ]
)

REPLAYS = StructType(
    [
        *_IDENTITY_FIELDS,
        *_fields(StringType(), "payload_hash", "replay_reason"),
        *_fields(TimestampType(), "original_first_seen_at", "replay_detected_at"),
    ]
)

REGISTRY = StructType(
    [
        *_IDENTITY_FIELDS,
        *_fields(StringType(), "payload_hash"),
        *_fields(TimestampType(), "first_seen_at", "last_seen_at"),
    ]
)

# A valid record, what was decided on it, and both.
RECORD = StructType([*TELEMETRY.fields, *_fields(StringType(), "payload_hash"), *_fields(TimestampType(), "arrival_ts"), *_fields(LongType(), "arrival_seq")])

DECISION = StructType(
    [
        *_fields(StringType(), "route", "replay_reason", "conflict_reason", "original_payload_hash", "conflicting_payload_hash"),
        *_fields(TimestampType(), "original_first_seen_at"),
    ]
)

DECIDED = StructType([*RECORD.fields, *DECISION.fields])

DEAD_LETTERS = StructType(_fields(StringType(), "value"))
