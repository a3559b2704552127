"""The stream against the batch flow, retries, and late data."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from driftwell.config import LATENCY_RANK_ERROR
from driftwell.operators import gold, quality, windows
from driftwell.plans.debug import debug_outputs, summed
from driftwell.plans.flow import TelemetryFlow
from driftwell.schemas import GOLD, NEW_EVENTS, SILVER
from driftwell.session import folder_names, remove
from driftwell.sources import events
from driftwell.sources.streams import file_bytes, file_messages, new_event_stream, silver_stream
from driftwell.sources.tables import Tables
from driftwell.streaming.alerts import STREAMS, start_alert
from driftwell.streaming.ingest import process_batch, start_ingest
from driftwell.streaming.windows import (
    arrival_counts_stream,
    fold_gold_updates,
    latest_gold,
    start_arrival_counts,
    start_gold,
    start_gold_updates,
    start_panes,
)

SF_DIR = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple("" if v is None else str(v) for v in r) for r in df.collect())


@pytest.fixture(scope="module")
def flow(spark):
    return TelemetryFlow(events.messages(events.events_table(spark, SF_DIR)), as_of=events.as_of())


@pytest.fixture(scope="module")
def run(spark, flow, tmp_path_factory):
    """The messages in three files by arrival, streamed one file at a time."""
    base = tmp_path_factory.mktemp("stream")
    inbox = str(base / "inbox")
    messages = flow.messages.withColumn("part", (F.unix_seconds("arrival_ts") - 1704067200).cast("long"))
    for low, high in ((0, 400), (400, 900), (900, 10**9)):
        part = messages.filter((F.col("part") >= low) & (F.col("part") < high)).drop("part")
        part.coalesce(1).write.mode("append").parquet(inbox)
    tables = Tables(spark, str(base / "tables"), registry_buckets=4).create(debug=True)
    stream = file_messages(spark, inbox, files_per_batch=1)
    start_ingest(
        stream, tables, str(base / "ck-ingest"), as_of=events.as_of(), debug=True, availableNow=True
    ).awaitTermination()
    return base, tables


def test_stream_tables_equal_the_batch_flow(run, flow):
    _, tables = run
    assert tables.read("silver").select("batch_id").distinct().count() == 3
    routed, new = flow.routed.cache(), flow.new
    expected = {
        "raw_telemetry": flow.telemetry.drop("arrival_ts", "arrival_seq"),
        "dead_letters": flow.dead_letters,
        "silver": windows.silver_rows(windows.assign_window(new)),
    }
    for name, want in expected.items():
        assert rows(tables.read(name).drop("batch_id")) == rows(want), name
    routes = {r.route: r["count"] for r in routed.groupBy("route").count().collect()}
    assert tables.read("replays").count() == routes["replay"]
    assert tables.read("conflicts").count() == routes["short_conflict"] + routes["conflict"]
    assert tables.registry.rows().count() == routes["new"]
    assert tables.read("registry_history").count() == routes["new"]
    counted = tables.read("stage_counts").groupBy("stage", "route").agg(F.sum("events"))
    assert rows(counted) == rows(flow.stage_counts.groupBy("stage", "route").agg(F.sum("events")))
    alert = quality.conflict_alert(tables.read("stage_counts"))
    assert rows(alert) == rows(quality.conflict_alert(flow.stage_counts))
    per_device = tables.spark.read.parquet(tables.path("event_time_count_debug"))
    assert per_device.agg(F.sum("record_count")).first()[0] == flow.telemetry.count()


def test_repeated_batch_changes_nothing(spark, flow, tmp_path):
    tables = Tables(spark, str(tmp_path / "t"), registry_buckets=4).create()
    names = ["raw_telemetry", "silver", "replays", "conflicts", "short_term_memory"]
    process_batch(flow.messages, 0, tables, events.as_of())
    before = {n: rows(tables.read(n)) for n in names}
    registered = rows(tables.registry.before(1))
    sent = []
    # An attempt that died before its last tables: everything else is there already.
    for lost in ("finished", "silver"):
        remove(spark, f"{tables.path(lost)}/batch_id=0")
    process_batch(flow.messages, 0, tables, events.as_of(), send_dead_letters=lambda df: sent.append(df.count()))
    assert sent == [tables.read("dead_letters").count()]
    assert {n: rows(tables.read(n)) for n in names} == before
    process_batch(flow.messages, 0, tables, events.as_of())
    assert {n: rows(tables.read(n)) for n in names} == before
    assert rows(tables.registry.before(1)) == registered
    # The same messages as another batch are replays or conflicts of the registered ones.
    process_batch(flow.messages, 1, tables, events.as_of())
    assert tables.read("silver").filter("batch_id = 1").count() == 0
    assert tables.read("replays").filter("batch_id = 1").count() > 0
    assert rows(tables.registry.rows()) == registered  # nothing new


def test_target_table_must_exist(spark, tmp_path):
    with pytest.raises(ValueError, match="does not exist"):
        Tables(spark, str(tmp_path)).write(spark.range(1), "silver", 0)


def test_gold_stream_final_rows(run, flow):
    """Append mode holds windows back until they are final; all others match the batch result."""
    base, tables = run
    silver = silver_stream(tables.spark, tables.path("silver"))
    start_gold(silver, tables, str(base / "ck-gold"), availableNow=True).awaitTermination()
    got = tables.read("gold").drop("batch_id")
    newest = flow.new.agg(F.max("event_timestamp")).first()[0] - timedelta(seconds=120)
    want = gold.gold(flow.windowed).filter(F.col("window_end") <= F.lit(newest))
    assert rows(got) == rows(want)
    assert got.count() > 0


def test_gold_stream_updates_give_every_window(run, flow):
    base, tables = run
    silver = silver_stream(tables.spark, tables.path("silver"))
    start_gold_updates(silver, tables, str(base / "ck-updates"), availableNow=True).awaitTermination()
    assert rows(latest_gold(tables)) == rows(gold.gold(flow.windowed))


def test_late_events_count_until_the_lateness_is_over(spark, tmp_path):
    """On time, late within two minutes, and too late, one micro-batch each."""
    inbox = str(tmp_path / "inbox")
    (tmp_path / "inbox").mkdir()
    start = datetime(2024, 1, 1)

    def send(name, *seconds):
        made = [(f"{name}{s}", "d", start + timedelta(seconds=s), 20.0 + s, 1.0, 1.0, 1.0, None, None) for s in seconds]
        spark.createDataFrame(made, SILVER).coalesce(1).write.mode("append").parquet(inbox)

    tables = Tables(spark, str(tmp_path / "t"), registry_buckets=4).create()

    def drain():
        silver = silver_stream(spark, inbox, files_per_batch=1)
        start_gold(silver, tables, str(tmp_path / "ck"), availableNow=True).awaitTermination()

    send("a", 10, 20)
    drain()
    send("late", 30, 100)  # the watermark is still before the first window's end
    drain()
    send("b", 400)  # moves the watermark past the first window
    drain()
    send("too-late", 40)
    drain()
    send("c", 800)
    drain()
    found = [(r.window_start, r.event_count) for r in tables.read("gold").collect()]
    assert found.count((start, 3)) == 1
    assert [count for begin, count in found if begin == start] == [3]


def test_arrival_counts_stream(spark, run, flow):
    base, _ = run
    flow.telemetry.select("device_id", "arrival_ts").coalesce(1).write.parquet(str(base / "valid"))
    stream = spark.readStream.schema("device_id string, arrival_ts timestamp").parquet(str(base / "valid"))
    query = (
        arrival_counts_stream(stream)
        .writeStream.format("memory").queryName("arrivals").outputMode("update")
        .option("checkpointLocation", str(base / "ck-arrivals"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert rows(spark.table("arrivals")) == rows(gold.device_arrival_counts(flow.telemetry))


def test_panes_as_they_fire(spark, tmp_path):
    """On-time panes once their window is over, late rows at once, rows beyond the lateness not at all."""
    draw, start = random.Random(3), datetime(2024, 1, 1)
    made = []
    for n in range(400):
        event = start + timedelta(seconds=n * 3)
        arrival = event + timedelta(seconds=draw.choice([-200, 1, 2, 30, 70, 100, 170, 200, 400]))
        begin = event - timedelta(seconds=event.second)
        made.append((f"e{n}", f"d{n % 3}", event, draw.choice([None, n * 0.25]), 1.0 * n, 900.0, 50.0, begin, begin + timedelta(seconds=60), arrival, n))
    made.sort(key=lambda r: r[9])
    inbox = str(tmp_path / "inbox")
    for part in (made[:150], made[150:300], made[300:]):
        spark.createDataFrame(part, NEW_EVENTS).coalesce(1).write.mode("append").parquet(inbox)
    tables = Tables(spark, str(tmp_path / "t"), registry_buckets=4).create()

    def drain():
        stream = new_event_stream(spark, inbox, files_per_batch=1)
        start_panes(stream, tables, str(tmp_path / "ck"), disorder_seconds=60, availableNow=True).awaitTermination()

    drain()
    wanted = gold.gold_panes(windows.classify_lateness(spark.createDataFrame(made, NEW_EVENTS)))
    early = tables.read("gold_panes").drop("batch_id")
    assert rows(early.filter("pane = 'late'")) == rows(wanted.filter("pane = 'late'"))
    assert 0 < early.filter("pane = 'on_time'").count() < wanted.filter("pane = 'on_time'").count()
    for day in (2, 3):  # later rows end all windows before them
        at = start + timedelta(days=day)
        spark.createDataFrame([("z", "z", at, *[1.0] * 4, at, at + timedelta(seconds=60), at, 9)], NEW_EVENTS).write.mode("append").parquet(inbox)
        drain()
    assert rows(tables.read("gold_panes").drop("batch_id").filter("device_id <> 'z'")) == rows(wanted)


def test_messages_named_by_their_files(spark, tmp_path):
    inbox = str(tmp_path / "inbox")
    body = spark.createDataFrame([(bytearray(f"m{n}".encode()),) for n in range(5)], "value binary")
    for _ in range(2):  # two files of equal contents
        body.coalesce(1).write.mode("append").parquet(inbox)

    def read(checkpoint):
        seen = []
        query = (
            file_bytes(spark, inbox, files_per_batch=1).writeStream.foreachBatch(lambda df, _: seen.extend(df.collect()))
            .option("checkpointLocation", str(tmp_path / checkpoint)).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return sorted((r.arrival_seq, bytes(r.value), r.arrival_ts) for r in seen)

    first = read("a")
    assert len({seq for seq, _, _ in first}) == 10 and all(seq >= 0 and at is not None for seq, _, at in first)
    assert {seq & (2**32 - 1) for seq, _, _ in first} == set(range(5))
    assert read("b") == first


def test_stored_latency(spark, run, flow):
    """What batches store gives the totals and, for windows that fit a sketch, the very distribution."""
    _, tables = run
    stored = tables.read("latency")
    measured = quality.measure_latency(flow.telemetry)
    totals = quality.merged_latency(stored).drop("sketch")
    assert rows(totals) == rows(quality.latency_stats(measured).drop("mean_ms"))
    got = {r.window_end: (r.events, r.p95_ms) for r in quality.latency_p95_windows(stored).collect()}
    end = F.window("arrival_ts", "5 minutes").end.alias("window_end")
    want = measured.groupBy(end).agg(F.count("*").alias("n"), F.expr("percentile_disc(0.95) WITHIN GROUP (ORDER BY latency_ms)").alias("p"))
    assert got == {r.window_end: (r.n, r.p) for r in want.collect()}
    exact = {r.window_end: r.firing for r in quality.latency_p95_alert(measured).collect()}
    assert {r.window_end: r.firing for r in quality.stored_latency_p95_alert(stored).collect()} == exact
    # Far more events than the sketch holds.
    many = spark.range(200_000).selectExpr("timestamp_seconds(1704067200 + id % 300) AS arrival_ts", "pmod(xxhash64(id), 100000) AS latency_ms")
    p95 = quality.latency_p95_windows(quality.latency_rollup(many)).first().p95_ms
    assert abs(many.filter(F.col("latency_ms") <= p95).count() / 200_000 - 0.95) <= 2 * LATENCY_RANK_ERROR
    assert quality.latency_rollup(many).agg(F.max(F.octet_length("sketch"))).first()[0] < 100_000


def test_updates_are_folded_by_days(spark, tmp_path):
    tables = Tables(spark, str(tmp_path), registry_buckets=4).create()
    start = datetime(2024, 1, 1, 23, 30)

    def update(batch, minutes):
        begins = [start + timedelta(minutes=m) for m in minutes]
        made = [("d", b, b + timedelta(seconds=60), batch + 1, *[1.0 * batch] * 6) for b in begins]
        tables.write(spark.createDataFrame(made, GOLD).coalesce(1), "gold_updates", batch)

    wanted = {}
    for batch in range(12):
        if batch and batch % 4 == 0:
            before = rows(latest_gold(tables))
            fold_gold_updates(tables, batch)
            assert rows(latest_gold(tables)) == before
            assert tables.read("gold_updates").count() == 0
        minutes = [batch, batch + 20, batch + 40]
        update(batch, minutes)
        wanted |= {m: batch + 1 for m in minutes}
    update(0, [11])  # left by a fold that died: an older version changes nothing
    fold_gold_updates(tables, 12)
    got = {(r.window_start - start).seconds // 60: r.event_count for r in latest_gold(tables).collect()}
    assert got == wanted
    days = [n for n in folder_names(spark, tables.path("gold_latest")) if n.startswith("day=")]
    assert sorted(days) == ["day=2024-01-01", "day=2024-01-02"]
    files = sum(len([n for n in folder_names(spark, f"{tables.path('gold_latest')}/{d}") if n.startswith("part")]) for d in days)
    assert files <= 8 and tables.batches("gold_updates") == []


def test_partial_counts_add_up(spark, run, flow):
    base, tables = run
    stream = new_event_stream(spark, tables.path("new_events"), files_per_batch=1)
    start_arrival_counts(stream, tables, str(base / "ck-counts"), availableNow=True).awaitTermination()
    assert rows(summed(tables.read("arrival_counts"))) == rows(gold.device_arrival_counts(flow.new))
    wanted = debug_outputs(flow.telemetry, flow.new)
    for name in ("arrival_count_debug", "event_time_count_debug", "gold_group_debug"):
        partial = spark.read.parquet(tables.path(name))
        assert rows(summed(partial)) == rows(wanted[name].select("device_id", "window_start", "window_end", "record_count")), name


def test_observed_totals(run, flow):
    """What was counted while the rows were written equals counting them afterwards."""
    _, tables = run
    observed = tables.read("batch_totals").groupBy("stage", "route").agg(F.sum("events"))
    assert rows(observed) == rows(flow.stage_counts.groupBy("stage", "route").agg(F.sum("events")))
    latency = tables.read("batch_latency").agg(F.sum("events"), F.sum("sum_ms"), F.min("min_ms"), F.max("max_ms"))
    measured = quality.measure_latency(flow.telemetry)
    assert rows(latency) == rows(measured.agg(*[f("latency_ms") for f in (F.count, F.sum, F.min, F.max)]))


def test_alerts_as_running_queries(spark, run, tmp_path):
    """Rows of the started queries equal the batch alerts over the same stored tables."""
    _, stored = run
    tables = Tables(spark, str(tmp_path / "t"), registry_buckets=4).create()
    for name in ("stage_counts", "latency"):
        for batch in sorted(stored.batches(name)):
            tables.write(stored.part(name, batch).coalesce(1), name, batch)
    last = stored.read("stage_counts").agg(F.max("minute")).first()[0]
    counts, latency = tables.read("stage_counts").cache(), tables.read("latency").cache()
    wanted = {
        "stage_rates": quality.stage_rates(counts),
        "alert_invalid_rate": quality.invalid_rate_alert(counts),
        "alert_conflict": quality.conflict_alert(counts),
        "alert_replay_rate": quality.replay_rate_alert(counts),
        "alert_latency_p95": quality.stored_latency_p95_alert(latency),
    }
    wanted = {name: rows(df.select(*tables.read(name).drop("batch_id").columns)) for name, df in wanted.items()}
    for day in (1, 2):  # later minutes end all windows before them
        at = last + timedelta(days=day)
        tables.write(spark.createDataFrame([(at, at + timedelta(minutes=1), "end", "end", 1)], counts.drop("batch_id").schema), "stage_counts", 1000 + day)
        tables.write(latency.limit(1).withColumn("minute", F.lit(at)).drop("batch_id"), "latency", 1000 + day)
    for name in STREAMS:
        start_alert(name, tables, str(tmp_path / name), files_per_batch=1, availableNow=True).awaitTermination()
        got = tables.read(name).filter(F.col("window_end") < F.lit(last + timedelta(hours=12))).drop("batch_id")
        assert rows(got) == wanted[name], name
        assert wanted[name], name
