"""Messages to tables, one micro-batch (or one bounded load) at a time.

The batch operators do the work, so a stream and a backfill give the same rows. What has to be known
from earlier batches is kept in tables: the registry for good, and the holders of the two ten-minute
stages for as long as a row can still meet them (see ``memory``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from driftwell.config import DISORDER_SECONDS
from driftwell.operators import identity, quality, totals, windows
from driftwell.operators.dead_letters import letters_by_stage
from driftwell.plans.debug import debug_outputs
from driftwell.plans.flow import TelemetryFlow, identity_routes, message_routes
from driftwell.session import configure, materialize, scratch
from driftwell.sources.tables import Tables
from driftwell.streaming import repair
from driftwell.streaming.memory import AGAIN, ShortTermMemory

# A row here says that all of a batch's tables are written; only then is what it remembered let go.
FINISHED, REGISTRY = "finished", "registry"


def process_batch(
    messages: DataFrame,
    batch_id: int,
    tables: Tables,
    as_of: Column | None = None,
    debug: bool = False,
    send_dead_letters: Callable[[DataFrame], None] | None = None,
    disorder_seconds: int = DISORDER_SECONDS,
) -> None:
    """Run every stage on ``messages`` and write all result tables; safe to repeat.

    ``send_dead_letters`` passes the quarantine messages on, e.g. to a topic, at least once. ``disorder_seconds``
    is how far arrivals of one source partition may be out of order across batches.
    """
    if tables.written(FINISHED, batch_id):
        return
    tables.registry.merge(batch_id)
    memory = ShortTermMemory(tables, batch_id, disorder_seconds)
    with scratch(messages.sparkSession):
        for name, rows in _outputs(stamped(messages, tables, batch_id), batch_id, tables, memory, as_of, debug):
            if name == REGISTRY:
                tables.registry.add(rows, batch_id)
            else:
                tables.write(rows, name, batch_id)
            if name == "dead_letters" and send_dead_letters is not None:
                send_dead_letters(rows)
    tables.write(messages.sparkSession.range(1).select(F.current_timestamp().alias("finished_at")), FINISHED, batch_id)
    memory.forget()
    tables.forget_before("batch_clock", batch_id)


def stamped(messages: DataFrame, tables: Tables, batch_id: int) -> DataFrame:
    """Arrivals on this side's clock: no arrival is later than its batch, one without a time is stamped with it."""
    return messages.withColumn("arrival_ts", F.least("arrival_ts", F.lit(tables.batch_time(batch_id))))


def _outputs(messages: DataFrame, batch_id: int, tables: Tables, memory: ShortTermMemory, as_of: Column | None, debug: bool):
    # Written tables carry the observed totals, so these hold what the tables hold, on a retry too.
    checks, decisions = Observation(), Observation()
    flow = TelemetryFlow(messages, as_of, watch=checks)
    checked, accepted = flow.checked, flow.accepted
    yield "raw_telemetry", accepted
    yield "dead_letters", letters_by_stage(checked).select("value")

    decided = identity.decide_identity(accepted, tables.registry.before(batch_id), memory.remembered())
    routed = materialize(decided.observe(decisions, *totals.identity_totals()), "routed")
    yield "batch_totals", tables.rows("batch_totals", totals.outcome_rows({**checks.get, **decisions.get}))
    yield "batch_latency", tables.rows("batch_latency", totals.latency_row(checks.get))
    new = routed.filter(F.col("route") == identity.NEW)

    yield repair.DECIDED_ROWS, routed
    holders, changed = identity.short_term_memory(routed), None
    ids = materialize(repair.out_of_order(accepted, memory), "out-of-order")
    if not ids.isEmpty():
        again = materialize(repair.decide_again(tables, ids, batch_id), "decided-again")
        yield repair.REPAIRS, repair.repairs(again)
        yield AGAIN, ids
        changed = tables.part(repair.REPAIRS, batch_id)
        holders = holders.join(ids, "event_id", "left_anti").unionByName(identity.short_term_memory(again))
    firsts = new if changed is None else new.unionByName(changed.filter(F.col("route") == identity.NEW), allowMissingColumns=True)
    registered = identity.registry_rows(firsts)

    yield "conflicts", identity.conflict_audit_rows(routed)
    yield "replays", identity.replay_audit_rows(routed)
    yield REGISTRY, registered
    yield "registry_history", registered

    yield from memory.advance(accepted, holders)

    routes = message_routes(checked).unionByName(identity_routes(routed)).unionByName(memory.behind(accepted))
    counts = quality.stage_counts(routes)
    if changed is not None:  # what the rows were counted as before, below zero, and what they are now
        before = quality.stage_counts(identity_routes(changed.withColumn("route", F.col("previous_route"))))
        counts = counts.unionByName(before.withColumn("events", -F.col("events"))).unionByName(quality.stage_counts(identity_routes(changed)))
    yield "stage_counts", counts
    yield "latency", quality.latency_rollup(quality.measure_latency(accepted))
    if debug:
        yield from debug_outputs(accepted, new).items()
    windowed = windows.assign_window(new)
    yield "new_events", windowed
    yield "silver", windows.silver_rows(windowed)


def start_ingest(
    messages: DataFrame,
    tables: Tables,
    checkpoint: str,
    as_of: Column | None = None,
    debug: bool = False,
    send_dead_letters: Callable[[DataFrame], None] | None = None,
    disorder_seconds: int = DISORDER_SECONDS,
    **trigger,
) -> StreamingQuery:
    """``trigger`` as for ``writeStream.trigger``, e.g. ``availableNow=True``."""
    configure(messages.sparkSession)
    return (
        messages.writeStream.queryName("ingest")
        .foreachBatch(lambda batch, number: process_batch(batch, number, tables, as_of, debug, send_dead_letters, disorder_seconds))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )

