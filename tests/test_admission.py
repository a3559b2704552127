"""Admission against a plain loop, on the folded and on the distributed path."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from driftwell.operators.copies import find_copies, narrow_rows
from driftwell.operators.identity import (
    check_conflicts,
    check_duplicates,
    decide_identity,
    detect_conflicts,
    registry_rows,
    short_term_memory,
)

BASE = datetime(2024, 1, 1, tzinfo=timezone.utc)
SCHEMA = (
    "event_id string, device_id string, event_timestamp timestamp, temperature double, humidity double, "
    "pressure double, battery_level double, arrival_ts timestamp, arrival_seq long, payload_hash string"
)


def record(event_id, arrival, seq, payload_hash, event_time):
    at = BASE + timedelta(microseconds=round(arrival * 1e6))
    event = BASE + timedelta(microseconds=round(event_time * 1e6))
    return (event_id, "d1", event, 1.0, 1.0, 1.0, 1.0, at, seq, payload_hash)


def random_records(seed):
    """Bursts, gaps around the ten minutes, equal instants, early and late event times."""
    rng = random.Random(seed)
    out, seq = [], 0
    for key in range(12):
        now = rng.uniform(0, 1000)
        payloads = [(f"h{i}", now + rng.choice([-900, -300, 0, 0, 250])) for i in range(rng.randint(1, 3))]
        for _ in range(rng.choice([1, 2, 3, 8, 40, 120])):
            payload_hash, event_time = rng.choice(payloads)
            if rng.random() < 0.2:
                event_time = now - rng.choice([0, 100, 599.5, 600, 700])
                payload_hash = f"t{int(event_time * 10)}"
            out.append(record(f"k{key}", now, seq, payload_hash, event_time))
            seq += 1
            now += rng.choice([0, 0.000001, 0.5, 3, 60, 299.999999, 300, 600, 600.000001, 1300])
            now = round(now, 6)
    rng.shuffle(out)
    return out


def loop(records, expiry):
    """{seq: (holder_hash, admitted)} by walking each id in arrival order."""
    state, result = {}, {}
    for r in sorted(records, key=lambda r: (r[0], r[7], r[8])):
        until, held = state.get(r[0], (None, None))
        free = until is None or r[7] >= until
        if free and expiry(r) > r[7]:
            state[r[0]] = (expiry(r), r[9])
        result[r[8]] = (r[9] if free else held, free)
    return result


def conflict_expiry(r):
    return r[7] + timedelta(seconds=600)


def dedup_expiry(r):
    return r[2] + timedelta(seconds=600)


def repeated_only(records, verdicts):
    counts = {}
    for r in records:
        counts[r[0]] = counts.get(r[0], 0) + 1
    return {r[8]: verdicts[r[8]] for r in records if counts[r[0]] > 1}


@pytest.mark.parametrize("seed,fold_copies,hot_rows", [(1, 256, 10**6), (2, 0, 10**6), (3, 5, 7), (4, 0, 3)])
def test_admission_equals_a_loop(spark, seed, fold_copies, hot_rows):
    records = random_records(seed)
    rows = narrow_rows(spark.createDataFrame(records, SCHEMA))
    copies = find_copies(rows, hot_rows)
    for check, expiry in (
        (lambda: check_conflicts(copies, fold_copies), conflict_expiry),
        (lambda: check_duplicates(copies.rows, copies, fold_copies), dedup_expiry),
    ):
        got = {r.arrival_seq: (r.holder_hash, r.admitted) for r in check().collect()}
        assert got == repeated_only(records, loop(records, expiry))


def expected_routes(records):
    conflicts = loop(records, conflict_expiry)
    clean = [r for r in records if conflicts[r[8]][0] == r[9]]
    kept = loop(clean, dedup_expiry)
    routes = {r[8]: "short_conflict" for r in records}
    registry = {}
    for r in sorted(clean, key=lambda r: (r[7], r[8])):
        if not kept[r[8]][1]:
            routes[r[8]] = "duplicate"
        elif r[0] not in registry:
            registry[r[0]] = r[9]
            routes[r[8]] = "new"
        else:
            routes[r[8]] = "replay" if registry[r[0]] == r[9] else "conflict"
    return routes


@pytest.mark.parametrize("fold_copies,hot_rows", [(256, 10**6), (3, 10)])
def test_all_stages_equal_a_loop(spark, fold_copies, hot_rows):
    records = random_records(7)
    routed = decide_identity(
        spark.createDataFrame(records, SCHEMA), fold_copies=fold_copies, hot_rows=hot_rows
    )
    assert {r.arrival_seq: r.route for r in routed.collect()} == expected_routes(records)


def test_one_id_with_a_third_of_all_rows(spark):
    """A hot id, a new payload each time: exact on the distributed path, in salted parts."""
    rng = random.Random(5)
    hot = [record("hot", i * 0.7 + rng.random() * 0.5, i, f"h{i % 5}", 0) for i in range(4000)]
    cold = [record(f"c{i}", i, 4000 + i, "h", i) for i in range(8000)]
    found = detect_conflicts(spark.createDataFrame(hot + cold, SCHEMA), hot_rows=100)
    want = loop(hot + cold, conflict_expiry)
    want = {r[8]: "clean" if want[r[8]][0] == r[9] else "conflict" for r in hot + cold}
    assert {r.arrival_seq: r.route for r in found.select("arrival_seq", "route").collect()} == want
    assert found.filter(F.col("route") == "conflict").count() > 3000


@pytest.mark.parametrize("fold_copies,hot_rows", [(256, 10**6), (3, 10)])
def test_two_batches_equal_one(spark, fold_copies, hot_rows):
    """What a batch leaves behind (registry and living holders) makes the next one decide alike."""
    records = random_records(11)
    arrivals = sorted(r[7] for r in records)
    cut = arrivals[len(arrivals) // 3]
    early = spark.createDataFrame([r for r in records if r[7] < cut], SCHEMA)
    late = spark.createDataFrame([r for r in records if r[7] >= cut], SCHEMA)
    sizes = {"fold_copies": fold_copies, "hot_rows": hot_rows}
    first = decide_identity(early, **sizes)
    registry = registry_rows(first.filter(F.col("route") == "new"))
    remembered = short_term_memory(first)
    assert remembered.count() > 0
    second = decide_identity(late, registry, remembered, **sizes)
    got = {r.arrival_seq: r.route for r in first.unionByName(second).collect()}
    assert got == expected_routes(records)
