"""What holds across micro-batches: memory, clocks, commits and merges."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from driftwell.operators.identity import decide_identity, registry_hits
from driftwell.plans.flow import TelemetryFlow
from driftwell.schemas import MESSAGES, REGISTRY, SILVER
from driftwell.session import folder_names, remove
from driftwell.sources.registry import Registry
from driftwell.sources.streams import broker_time
from driftwell.sources.tables import Tables
from driftwell.streaming.ingest import process_batch
from driftwell.streaming.memory import horizon

START = datetime(2024, 1, 1)


def message(event_id, seconds, number, warmth=21.5, partition=0, event_time=None):
    at = START + timedelta(seconds=seconds)
    body = {
        "event_id": event_id,
        "device_id": "probe-7",
        "event_timestamp": event_time or at.strftime("%Y-%m-%dT%H:%M:%SZ"),
        "temperature": warmth,
        "humidity": 44.0,
        "pressure": 1003.0,
        "battery_level": 61.0,
    }
    return (bytearray(json.dumps(body).encode()), at, (partition << 44) + number)


def frame(spark, *messages):
    return spark.createDataFrame(list(messages), MESSAGES)


def decisions(tables):
    counted = tables.read("stage_counts").groupBy("stage", "route").agg(F.sum("events").alias("n"))
    return {(r.stage, r.route): r.n for r in counted.collect()}


@pytest.mark.parametrize("ahead", [0, 1])
def test_an_id_is_remembered_while_others_run_ahead(spark, tmp_path, ahead):
    """Z runs ahead, in the partition of A or in another; A's holder is still there for A's later rows."""
    first = [message("A", 0, 1), message("Z", 10_000, 2, partition=ahead)]
    own_time = first[0][1].strftime("%Y-%m-%dT%H:%M:%SZ")  # copies keep the event's time
    second = [message("A", 100, 3, warmth=30.0, event_time=own_time), message("A", 200, 4, event_time=own_time)]
    whole = decide_identity(TelemetryFlow(frame(spark, *first, *second)).fingerprinted)
    want = sorted(r.route for r in whole.select("route").collect())
    assert want == ["duplicate", "new", "new", "short_conflict"]
    tables = Tables(spark, str(tmp_path), registry_buckets=4).create()
    process_batch(frame(spark, *first), 0, tables)
    process_batch(frame(spark, *second), 1, tables)
    found = decisions(tables)
    assert found["conflict_check", "conflict"] == 1
    assert found["deduplication", "dropped"] == 1
    assert found["registry", "new"] == 2
    assert ("registry", "conflict") not in found and ("arrival", "behind") not in found


def test_memory_grows_by_the_batch_and_expires(spark, tmp_path):
    tables = Tables(spark, str(tmp_path), registry_buckets=4).create()
    process_batch(frame(spark, message("A", 0, 1), message("B", 1, 2)), 0, tables)
    process_batch(frame(spark, message("C", 60, 3)), 1, tables)
    parts = tables.read("short_term_memory").groupBy("batch_id").agg(F.count_distinct("event_id").alias("n"))
    assert {r.batch_id: r.n for r in parts.collect()} == {0: 2, 1: 1}
    process_batch(frame(spark, message("D", 50_000, 4)), 2, tables)
    assert sorted(n for n in folder_names(spark, tables.path("short_term_memory")) if "=" in n) == ["batch_id=2"]
    process_batch(frame(spark, message("A", 30, 5)), 3, tables)  # behind by more than the disorder
    assert decisions(tables)["arrival", "behind"] == 1


def test_the_partition_furthest_behind_decides(spark):
    progress = spark.createDataFrame(
        [(0, START), (1, START + timedelta(hours=5)), (2, START - timedelta(days=30))],
        "source_partition long, last_arrival timestamp",
    )
    assert horizon(progress, 600) == START - timedelta(seconds=600)  # the idle one does not count
    assert horizon(progress.limit(0)) is None


def test_a_clock_ahead_moves_nothing(spark, tmp_path):
    """An arrival in the year 2999 is taken as the time of its batch, so its event time is refused."""
    tables = Tables(spark, str(tmp_path), registry_buckets=4).create()
    body, _, number = message("odd", 0, 2, event_time="2999-01-01T00:00:00Z")
    odd = (body, datetime(2999, 1, 1), number)
    unstamped = (message("late", 0, 7)[0], None, 7)
    process_batch(frame(spark, message("A", 0, 1), odd), 0, tables)
    process_batch(frame(spark, message("A", 100, 3, warmth=30.0)), 1, tables)
    assert tables.read("dead_letters").count() == 1
    assert tables.read("silver").count() == 1
    assert decisions(tables)["conflict_check", "conflict"] == 1
    process_batch(frame(spark, unstamped), 2, tables)
    seen = tables.registry.rows().filter("event_id = 'late'").first().first_seen_at
    assert seen > START + timedelta(days=300)


def test_only_the_broker_stamps(spark):
    rows = spark.createDataFrame([(0, START), (1, START)], "timestampType int, timestamp timestamp")
    assert [r[0] for r in rows.select(broker_time()).collect()] == [None, START]


def test_a_partition_shows_only_whole(spark, tmp_path):
    tables = Tables(spark, str(tmp_path), registry_buckets=4).create()
    rows = spark.range(10).select(F.col("id").cast("string").alias("event_id"))
    rows = rows.select(*[F.col(f.name) if f.name == "event_id" else F.lit(None).cast(f.dataType).alias(f.name) for f in SILVER])
    broken = rows.repartition(5).withColumn("device_id", F.when(F.col("event_id") == "7", F.raise_error(F.lit("lost"))))
    with pytest.raises(Exception, match="lost"):
        tables.write(broken, "silver", 0)
    assert tables.read("silver").count() == 0 and not tables.written("silver", 0)
    tables.write(rows, "silver", 0)
    names = folder_names(spark, f"{tables.path('silver')}/batch_id=0")
    tables.write(rows.limit(3), "silver", 0)  # what is there stays, under the same names
    assert sorted(folder_names(spark, f"{tables.path('silver')}/batch_id=0")) == sorted(names)
    tables.write(rows.limit(4), "silver", 1)
    assert {r.batch_id: r["count"] for r in tables.read("silver").groupBy("batch_id").count().collect()} == {0: 10, 1: 4}
    tables.write(rows.limit(0), "silver", 2)
    assert tables.read("silver").count() == 14 and tables.part("silver", 2).count() == 0


def test_a_batch_that_died_half_way_is_finished(spark, tmp_path):
    """With rows that depend on what the batch before left behind, which must still be there for the retry."""
    first = [message("A", 0, 1), message("B", 1, 2)]
    own_time = first[0][1].strftime("%Y-%m-%dT%H:%M:%SZ")
    second = [message("A", 100, 3, warmth=30.0, event_time=own_time), message("A", 5_000, 4, event_time=own_time), message("C", 101, 5)]
    tables = Tables(spark, str(tmp_path), registry_buckets=4).create()
    process_batch(frame(spark, *first), 0, tables)
    with pytest.raises(Exception, match="died"):
        process_batch(frame(spark, *second), 1, tables, send_dead_letters=fail)
    process_batch(frame(spark, *second), 1, tables)
    assert (tables.read("replays").count(), tables.read("conflicts").count(), tables.read("silver").count()) == (1, 1, 3)


def fail(letters):
    raise RuntimeError("died")


def registered(spark, *ids, second=0):
    at = START + timedelta(seconds=second)
    return spark.createDataFrame([(i, "d", START, f"hash-{i}", at, at) for i in ids], REGISTRY)


def test_a_lookup_leaves_the_registry_where_it_lies(spark, tmp_path):
    registry = Registry(spark, str(tmp_path / "r"), buckets=4, fan=3).create()
    for number in range(3):
        registry.add(registered(spark, *[f"e{number}-{i}" for i in range(50)]), number)
    asked = spark.createDataFrame([(f"e{n}-{i}",) for n in range(4) for i in range(0, 50, 7)] * 2, "event_id string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hits = registry_hits(asked, registry.before(2))
        plan = hits._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan
        side = plan[plan.index("SortMergeJoin") : plan.index("FileScan")]
        assert "Exchange" not in side  # from the registry's files to the join
        assert plan.count("Exchange hashpartitioning") <= 2  # the ids made distinct, and dealt to the buckets
        assert sorted(r.event_id for r in hits.collect()) == sorted(f"e{n}-{i}" for n in range(2) for i in range(0, 50, 7))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_parts_are_merged_in_levels(spark, tmp_path):
    registry = Registry(spark, str(tmp_path / "r"), buckets=4, fan=3).create()
    ids = []
    for number in range(10):
        registry.merge(number)
        ids.append(f"e{number}")
        registry.add(registered(spark, ids[-1]), number)
        assert sorted(r.event_id for r in registry.rows().collect()) == ids
    assert (registry.parts(0), registry.parts(1), registry.parts(2)) == ([9], [], [8])
    assert registry.before(9).count() == 9
    files = [n for n in folder_names(spark, f"{registry.path}/level=2/batch_id=8") if n.startswith("part")]
    assert len(files) <= 4


def test_a_merge_that_was_cut_short_changes_no_lookup(spark, tmp_path):
    registry = Registry(spark, str(tmp_path / "r"), buckets=4, fan=2).create()
    for number in range(2):
        registry.add(registered(spark, f"e{number}", "e0" if number else "x", second=number), number)
    registry._write(registry._level_rows(0, 1), 1, 1)  # and died before the parts were removed
    asked = spark.createDataFrame([("e0",), ("e1",), ("z",)], "event_id string")
    hits = {r.event_id: r.remembered_at for r in registry_hits(asked, registry.before(2)).collect()}
    assert hits == {"e0": START, "e1": START + timedelta(seconds=1)}
    registry.merge(2)
    assert registry.parts(0) == [] and sorted(r.event_id for r in registry.rows().collect()) == ["e0", "e1", "x"]
    fresh = Registry(spark.newSession(), registry.path, buckets=4)  # another driver finds the same rows
    assert fresh.rows().count() == 3


def test_the_registry_is_merged_by_the_ingest(spark, tmp_path):
    tables = Tables(spark, str(tmp_path), registry_buckets=4).create()
    for number in range(9):
        tables.registry.add(registered(spark, f"id{number}"), number)
    process_batch(frame(spark, message("id0", 2_000, 9, event_time="2024-01-01T00:00:00Z")), 9, tables)
    assert (tables.registry.parts(0), tables.registry.parts(1)) == ([], [8])
    assert tables.registry.rows().count() == 9
    assert decisions(tables)["registry", "conflict"] == 1
