"""Telemetry messages derived from the ``events`` table.

``events`` holds no telemetry, so every row becomes one device message (some become two or three)
by integer arithmetic on its id ``n``. ``FIXTURES.md`` lists the classes by ``k = n % 100``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwell.functions.once import compute_once

AS_OF = "2024-02-15T00:00:00Z"

# k: extra copies as (seconds after the first arrival, temperature change, other spelling).
_COPIES = {
    **{k: [(30, 0.0, False)] for k in range(2, 100, 10)},
    **{k: [(60, 1.0, False)] for k in (4, 54)},
    **{k: [(90, 0.0, True)] for k in (6, 56)},
    8: [(1800, 0.0, False)],
    28: [(1800, 1.0, False)],
    48: [(300, 0.0, False), (700, 1.0, False)],
}
_DELAYS = {31: 90, 33: 90, 37: 300}

# k: JSON texts put in place of the regular ones, in every other block of 1000 events.
_FAULTS = {
    1: {"shape": "truncated"},
    3: {"temperature": "999"},
    5: {"humidity": "-10"},
    7: {"device_id": '"device 001"'},
    9: {"shape": "naive"},
    11: {"shape": "no_pressure"},
    13: {"event_id": "null"},
    15: {"temperature": '"not-a-number"'},
    17: {"shape": "quoted_temperature"},
    19: {"temperature": "null"},
    21: {"temperature": "null", "humidity": "null", "pressure": "null", "battery_level": "null"},
    23: {"event_timestamp": '"2999-01-01T00:00:00Z"'},
    25: {"temperature": "999", "humidity": "-10", "battery_level": "150"},
    27: {"event_id": "12345"},
    29: {"shape": "not_object"},
    35: {"shape": "trailing"},
    39: {"event_id": '""'},
    41: {"device_id": "17"},
    43: {"event_timestamp": '"yesterday"'},
    45: {"event_timestamp": "1704067200"},
    47: {"pressure": "700"},
    49: {"pressure": '"abc"'},
    51: {"shape": "bom"},
}
_TEXTS = ["event_id", "device_id", "event_timestamp", "temperature", "humidity", "pressure", "battery_level"]


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id")
    # A small table is one scan task; the JSON work behind it should still use every core.
    cores = spark.sparkContext.defaultParallelism
    return events.repartition(cores) if events.rdd.getNumPartitions() < cores else events


def _schedule(spark: SparkSession) -> DataFrame:
    """One row per class and copy: 118 rows, whatever the size of ``events``."""

    def sql(value):
        if value is None:
            return "cast(null as string)"
        return f"'{value}'" if isinstance(value, str) else str(value).lower()

    rows = []
    for k in range(100):
        fault = _FAULTS.get(k, {})
        texts = [sql(fault.get(name)) for name in ("shape", *_TEXTS)]
        for copy, (delay, warmer, other) in enumerate([(_DELAYS.get(k, 0), 0.0, False), *_COPIES.get(k, [])]):
            rows.append(f"({k}L, {copy}, {delay}, {warmer}D, {sql(other)}, {', '.join(texts)})")
    names = ", ".join(["k", "copy", "delay", "warmer", "other", "shape", *[f"{t}_fault" for t in _TEXTS]])
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS schedule({names})")


def messages(events: DataFrame) -> DataFrame:
    """``value`` bytes with ``arrival_ts`` and ``arrival_seq``. A map over ``events``: no shuffle."""
    numbered = events.selectExpr(
        "event_id AS n",
        "event_id % 100 AS k",
        "event_id div 1000 % 2 = 0 AS faulty",
        "concat('device-', lpad(cast(user_id % 20 as string), 3, '0')) AS device",
    )
    copies = numbered.join(F.broadcast(_schedule(events.sparkSession)), "k")

    # Nothing is faulty in every other block.
    faults = [f"CASE WHEN faulty THEN {c} END AS {c}" for c in ("shape", *[f"{t}_fault" for t in _TEXTS])]
    active = copies.selectExpr(
        "n", "copy", "delay", "warmer", "other", "device", "timestamp_seconds(1704067200 + n) AS event_time", *faults
    )
    zone = "CASE WHEN shape = 'naive' THEN '' WHEN other THEN '+00:00' ELSE 'Z' END"
    stamp = "date_format(event_time, \"yyyy-MM-dd'T'HH:mm:ss\")"
    fields = active.selectExpr(
        "n", "copy", "delay", "event_time", "shape",
        f"coalesce(event_id_fault, {_quoted("concat('evt-', n)")}) AS event_id",
        f"coalesce(device_id_fault, {_quoted('device')}) AS device_id",
        f"coalesce(event_timestamp_fault, {_quoted(f'concat({stamp}, {zone})')}) AS event_timestamp",
        _reading("temperature", "20 + (n * 7 % 81) * 0.25D + warmer", "other OR coalesce(shape, '') = 'quoted_temperature'"),
        _reading("humidity", "30 + (n * 11 % 201) * 0.25D"),
        _reading("pressure", "990 + (n * 13 % 161) * 0.25D"),
        _reading("battery_level", "20 + (n * 17 % 321) * 0.25D"),
    )
    return compute_once(
        fields,
        value=f"cast({_message_text()} as binary)",
        arrival_ts="timestamp_seconds(unix_seconds(event_time) + n % 5 + delay)",
        arrival_seq="n * 10 + copy",
    ).select("value", "arrival_ts", "arrival_seq")


def _quoted(text: str) -> str:
    return f"""concat('"', {text}, '"')"""


def _reading(name: str, value: str, as_text: str = "other") -> str:
    text = f"cast({value} as string)"
    return f"coalesce({name}_fault, if({as_text}, {_quoted(text)}, {text})) AS {name}"


def _message_text() -> str:
    shown = [f"""concat('"{name}": ', {name})""" for name in _TEXTS]
    at = _TEXTS.index("pressure")
    shown[at] = f"CASE WHEN coalesce(shape, '') <> 'no_pressure' THEN {shown[at]} END"
    body = f"concat('{{', concat_ws(', ', {', '.join(shown)}))"
    return (
        f"CASE coalesce(shape, '') WHEN 'truncated' THEN {body} WHEN 'not_object' THEN '[1]' "
        f"WHEN 'trailing' THEN concat({body}, '}} x') WHEN 'bom' THEN concat('\\ufeff', {body}, '}}') "
        f"ELSE concat({body}, '}}') END"
    )


#: Of the ids in edge messages, by ``n % 8``: (event_id, device_id) as SQL for bytes; the longest id has 100 characters.
_EDGES = [
    ("rpad(concat('evt-', n, '-'), 100, 'x')", "'probe'"),
    ("rpad(concat('evt-', n, '-'), 101, 'x')", "'probe'"),
    ("concat('evt-', n)", "repeat('d', 101)"),
    ("concat('evt-', n)", "'   '"),
    ("concat(chr(160), ' ')", "'probe'"),
    ("concat('evt-', n)", "X'70FF71'"),
    ("concat(cast(concat('evt-', n) as binary), X'C3')", "'probe'"),
    ("concat('evt-', n)", "repeat('d', 100)"),
]


def edge_messages(events: DataFrame) -> DataFrame:
    """A message per event whose ids are at the edges of the rules, or hold bytes that are no text."""

    def pick(at: int) -> str:
        cases = " ".join(f"WHEN {kind} THEN cast({ids[at]} as binary)" for kind, ids in enumerate(_EDGES))
        return f"CASE n % 8 {cases} END"

    numbered = events.selectExpr("event_id AS n")
    texts = ["'{\"event_id\": \"'", pick(0), "'\", \"device_id\": \"'", pick(1), """'", "event_timestamp": "2024-01-01T00:00:00Z", "temperature": 1, "humidity": 2, "pressure": 900, "battery_level": 3}'"""]
    value = ", ".join(f"cast({t} as binary)" for t in texts)
    return numbered.selectExpr(f"concat({value}) AS value", "timestamp_seconds(1704067200 + n) AS arrival_ts", "n AS arrival_seq")
