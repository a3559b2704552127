"""Windows, gold, audits and alerts on small tables with known answers."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from driftwell.operators import gold, identity, quality, windows
from driftwell.schemas import TELEMETRY

START = datetime(2024, 1, 1)


def reading(device, second, temperature, humidity, pressure, battery):
    return (f"{device}-{second}", device, START + timedelta(seconds=second), temperature, humidity, pressure, battery)


def windowed(spark, rows):
    return windows.assign_window(spark.createDataFrame(rows, TELEMETRY))


def test_window_bounds_are_half_open(spark):
    rows = [reading("d", s, 1.0, 1.0, 1.0, 1.0) for s in (0, 59, 60, 119, -1)]
    got = {r.event_timestamp: (r.window_start, r.window_end) for r in windowed(spark, rows).collect()}
    for second, begin in ((0, 0), (59, 0), (60, 60), (119, 60), (-1, -60)):
        at = START + timedelta(seconds=begin)
        assert got[START + timedelta(seconds=second)] == (at, at + timedelta(seconds=60))


def test_gold_counts_nulls_as_events_only(spark):
    rows = [
        reading("a", 1, 10.0, 40.0, 1000.0, 90.0),
        reading("a", 2, None, 50.0, None, 80.0),
        reading("a", 3, 30.0, None, 1010.0, None),
        reading("b", 4, None, None, None, None),
        reading("a", 61, 5.0, 5.0, 900.0, 5.0),
    ]
    got = sorted(tuple(r) for r in gold.gold(windowed(spark, rows)).collect())
    first, second, third = (START + timedelta(seconds=60 * i) for i in range(3))
    assert got == [
        ("a", first, second, 3, 20.0, 10.0, 30.0, 45.0, 1005.0, 85.0),
        ("a", second, third, 1, 5.0, 5.0, 5.0, 5.0, 900.0, 5.0),
        ("b", first, second, 1, None, None, None, None, None, None),
    ]


def test_gold_combines_before_it_shuffles(spark):
    plan = gold.gold(windowed(spark, [reading("a", 1, 1.0, 1.0, 1.0, 1.0)]))._jdf.queryExecution().toString()
    assert "partial_avg" in plan and plan.index("partial_avg") > plan.index("Exchange hashpartitioning")


def test_late_rows_are_panes_of_their_own(spark):
    rows = spark.createDataFrame(
        [(*reading("d", s, float(s), 1.0, 1.0, 1.0), START + timedelta(seconds=arrival)) for s, arrival in
         ((1, 2), (2, 59), (3, 60), (4, 179), (5, 180))],
        StructType([*TELEMETRY.fields, StructField("arrival_ts", TimestampType())]),
    )
    panes = gold.gold_panes(windows.classify_lateness(windows.assign_window(rows))).collect()
    got = sorted((r.pane, r.late_event_id, r.event_count, r.avg_temperature) for r in panes if r.pane == "late")
    assert got == [("late", "d-3", 1, 3.0), ("late", "d-4", 1, 4.0)]
    assert [(r.event_count, r.avg_temperature) for r in panes if r.pane == "on_time"] == [(2, 1.5)]


def test_pairs_are_new_replay_or_conflict(spark):
    pairs = spark.createDataFrame(
        [("a", "h", None, None), ("b", "h", "h", START), ("c", "h", "g", START)],
        "event_id string, payload_hash string, registered_hash string, registered_first_seen_at timestamp",
    )
    got = {r.event_id: r.asDict() for r in identity.classify_pairs(pairs).collect()}
    assert [got[k]["route"] for k in "abc"] == ["new", "replay", "conflict"]
    assert got["b"]["replay_reason"] == "event_id_and_payload_hash_already_seen"
    assert got["b"]["original_first_seen_at"] == START
    assert got["c"]["conflict_reason"] == "same_event_id_different_payload_hash"
    assert (got["c"]["original_payload_hash"], got["c"]["conflicting_payload_hash"]) == ("g", "h")
    assert got["a"]["conflict_reason"] is None and got["a"]["replay_reason"] is None


def test_latency_is_cut_toward_zero(spark):
    rows = spark.createDataFrame(
        [(START, START + timedelta(microseconds=m)) for m in (1999, -1999, 30_000_000)],
        "event_timestamp timestamp, arrival_ts timestamp",
    )
    assert [r.latency_ms for r in quality.measure_latency(rows).collect()] == [1, -1, 30000]


def minute_counts(spark, rows):
    made = [(START + timedelta(minutes=m), stage, route, n) for m, stage, route, n in rows]
    return spark.createDataFrame(made, "minute timestamp, stage string, route string, events long")


def test_invalid_rate_must_be_sustained(spark):
    bad = [(m, "validation", r, n) for m in range(0, 8) for r, n in (("valid", 9), ("invalid", 1))]
    good = [(m, "validation", "valid", 500) for m in range(8, 12)]
    late = [(m, "validation", "invalid", 1) for m in range(30, 33)]
    alert = quality.invalid_rate_alert(minute_counts(spark, bad + good + late))
    firing = sorted((r.window_end - START) // timedelta(minutes=1) for r in alert.filter("firing").collect())
    # Breached from minute 1 on; five minutes later it fires, until the good minutes dilute the rate.
    # The lone rejects of minutes 30 to 32 breach at 31 to 37.
    assert firing == [6, 7, 8, 36, 37]


def test_conflicts_and_replays_alert_at_once(spark):
    counts = minute_counts(
        spark,
        [(0, "conflict_check", "conflict", 1), (0, "conflict_check", "clean", 9)]
        + [(0, "registry", "new", 97), (0, "registry", "replay", 2), (0, "registry", "conflict", 1)]
        + [(20, "registry", "replay", 3), (20, "registry", "new", 97)],
    )
    ends = [(r.window_end - START) // timedelta(minutes=1) for r in quality.conflict_alert(counts).collect()]
    assert sorted(ends) == [1, 2, 3, 4, 5]
    replay = quality.replay_rate_alert(counts)
    firing = [(r.window_end - START) // timedelta(minutes=1) for r in replay.filter("firing").collect()]
    assert sorted(firing) == [21, 22, 23, 24, 25]  # 2 percent exactly does not fire


def test_p95_over_distinct_values_is_exact(spark):
    values = [10] * 90 + [100, 200, 300, 400, 500, 40_000, 50_000, 60_000, 70_000, 80_000]
    rows = [(START + timedelta(minutes=5 * w, seconds=1), v) for w in (0, 1, 3) for v in values]
    measured = spark.createDataFrame(rows, "arrival_ts timestamp, latency_ms long")
    got = {(r.window_end - START) // timedelta(minutes=5): r for r in quality.latency_p95_alert(measured).collect()}
    want = measured.filter(F.col("arrival_ts") < START + timedelta(minutes=5)).selectExpr("percentile(latency_ms, 0.95)")
    assert got[1].p95_ms == want.first()[0] and not got[1].breached
    slow = measured.withColumn("latency_ms", F.col("latency_ms") + 40_000)
    firing = {(r.window_end - START) // timedelta(minutes=5): r.firing for r in quality.latency_p95_alert(slow).collect()}
    assert firing == {1: False, 2: True, 4: False}
