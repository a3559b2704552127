"""Fixed values of the telemetry contract: fields, limits, durations and audit texts."""

# Required fields, in the order their errors are reported.
REQUIRED_FIELDS = [
    "event_id",
    "device_id",
    "event_timestamp",
    "temperature",
    "humidity",
    "pressure",
    "battery_level",
]

# Inclusive (min, max) per sensor, in the order they are checked.
SENSOR_RANGES = {
    "temperature": (-50.0, 100.0),
    "humidity": (0.0, 100.0),
    "pressure": (800.0, 1200.0),
    "battery_level": (0.0, 100.0),
}
SENSORS = list(SENSOR_RANGES)

# Id length limits in code points, and the allowed clock skew ahead.
ID_MIN_LENGTH = 1
ID_MAX_LENGTH = 100
MAX_FUTURE_SECONDS = 300

# Durations in seconds.
WINDOW_SECONDS = 60
ALLOWED_LATENESS_SECONDS = 120
DEDUPLICATION_SECONDS = 600
CONFLICT_TTL_SECONDS = 600

# Texts written into audit rows and quarantine envelopes.
CONFLICT_REASON = "same_event_id_different_payload_hash"
REPLAY_REASON = "event_id_and_payload_hash_already_seen"
PARSE_STAGE = "json_parsing"
VALIDATION_STAGE = "validation"

# Monitoring thresholds.
RATE_WINDOW_MINUTES = 5
SUSTAIN_MINUTES = 5
INVALID_RATE_PERCENT = 5.0
REPLAY_RATE_PERCENT = 2.0
LATENCY_P95_MS = 30000.0

# Engine sizes (ours). A key with at most FOLD_COPIES copies is folded as one bounded array; a
# key with more takes the distributed path. A key is spread over one salt per HOT_ROWS copies. The registry
# is stored in buckets, and so many parts of a level are merged into one.
FOLD_COPIES = 256
HOT_ROWS = 1_000_000
REGISTRY_BUCKETS = 256
REGISTRY_FAN = 8

# Streams (ours). Bits of ``arrival_seq`` below the source partition; how far a partition's arrivals may be
# out of order; after how long a silent partition is taken as idle.
SOURCE_PARTITION_BITS = 44
DISORDER_SECONDS = 10_800
IDLE_SECONDS = 86_400

# Latency sketches (ours): the size parameter of a KLL sketch, and its error in ranks, 2.296 / k ** 0.9723 rounded up.
LATENCY_SKETCH = 1000
LATENCY_RANK_ERROR = 0.003

# Streams (ours): batches of gold updates between two folds.
FOLD_EVERY = 32

# Streams (ours): how long an alert waits for rows of a minute that is over.
ALERT_WAIT_SECONDS = 120
