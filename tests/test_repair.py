"""Rows out of order across batches, and far behind, against one load of all messages."""

import random

import pytest
from pyspark.sql import functions as F

from driftwell.operators import identity, windows
from driftwell.plans.flow import TelemetryFlow
from driftwell.schemas import DECIDED
from driftwell.session import remove
from driftwell.sources.tables import Tables
from driftwell.streaming.ingest import process_batch
from driftwell.streaming.memory import ShortTermMemory
from driftwell.streaming.repair import settled
from tests.test_batches import START, frame, message


def rows(df):
    return sorted(tuple("" if v is None else str(v) for v in r) for r in df.collect())


def sums(counts):
    counted = counts.filter("stage <> 'arrival'").groupBy("minute", "stage", "route").agg(F.sum("events").alias("n"))
    return rows(counted.filter("n <> 0"))


def drawn(seed, parts):
    """Few ids, often repeated, with two payloads; each part takes any of the messages but the last one a whole partition."""
    draw, made = random.Random(seed), [[] for _ in range(parts)]
    stamp = START.strftime("%Y-%m-%dT%H:%M:%SZ")
    for n in range(160):
        partition = draw.choice([0, 0, 1, 2])
        part = parts - 1 if partition == 2 else min(n * parts // 160 + draw.choice([0, 0, 1]), parts - 1)
        seconds = n * 20 + draw.choice([0, 0, -40, -700])
        event_time = draw.choice([None, stamp])
        made[part].append(message(f"e{draw.randint(0, 14)}", max(seconds, 0), n, draw.choice([20.0, 20.0, 30.0]), partition, event_time))
    return made


def test_settled_rows_equal_one_load(spark, tmp_path):
    parts = drawn(1, 3)
    flow = TelemetryFlow(frame(spark, *[m for part in parts for m in part]))
    tables = Tables(spark, str(tmp_path), registry_buckets=4).create()
    for number, part in enumerate(parts):
        process_batch(frame(spark, *part), number, tables, disorder_seconds=30)
    found = settled(tables)
    assert rows(found) == rows(flow.routed.select(*DECIDED.names))
    new = found.filter(F.col("route") == identity.NEW)
    assert rows(windows.silver_rows(windows.assign_window(new))) == rows(windows.silver_rows(flow.windowed))
    assert rows(identity.conflict_audit_rows(found)) == rows(identity.conflict_audit_rows(flow.routed))
    assert rows(identity.replay_audit_rows(found)) == rows(identity.replay_audit_rows(flow.routed))
    assert sums(tables.read("stage_counts")) == sums(flow.stage_counts)
    assert tables.read("repairs").count() > 0
    known = identity.registry_hits(found, tables.registry.before(99)).select("event_id", "remembered_hash", "remembered_at")
    assert rows(known) == rows(flow.new.select("event_id", "payload_hash", "arrival_ts"))


def test_a_batch_in_order_reads_no_history(spark, tmp_path):
    tables = Tables(spark, str(tmp_path), registry_buckets=4).create()
    process_batch(frame(spark, message("A", 0, 1), message("B", 1, 2)), 0, tables)
    process_batch(frame(spark, message("A", 60, 3), message("C", 61, 4)), 1, tables)
    assert tables.batches("decided_again") == tables.batches("repairs") == []
    assert settled(tables).count() == 4


def test_a_repair_can_be_tried_again(spark, tmp_path, monkeypatch):
    tables = Tables(spark, str(tmp_path), registry_buckets=4).create()
    stamp = START.strftime("%Y-%m-%dT%H:%M:%SZ")
    process_batch(frame(spark, message("A", 20_000, 1, event_time=stamp)), 0, tables)
    late = frame(spark, message("A", 30, 2, warmth=30.0, event_time=stamp))
    with monkeypatch.context() as patched, pytest.raises(RuntimeError, match="died"):
        patched.setattr(ShortTermMemory, "advance", fail)
        process_batch(late, 1, tables)
    assert settled(tables).count() == 1  # only finished batches are read
    process_batch(late, 1, tables)
    changed = {(r.arrival_seq, r.previous_route, r.route) for r in tables.read("repairs").collect()}
    assert changed == {(1, "new", "conflict"), (2, "short_conflict", "new")}
    process_batch(frame(spark, message("A", 30_000, 3, warmth=30.0, event_time=stamp)), 2, tables)
    assert {r.arrival_seq: r.route for r in settled(tables).collect()} == {1: "conflict", 2: "new", 3: "replay"}


def fail(*_):
    raise RuntimeError("died")
