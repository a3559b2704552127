"""Rows that arrive out of order are decided again, together with all stored rows of their ids.

A batch decides its rows against what it remembers. That is not enough for a row that arrives before a remembered
holder of its id, or before the horizon of the memory: a load would have decided it, and rows of its id after it,
in another way. So each batch stores its decisions (``decided``), and a batch with such rows fetches the stored rows
of just their ids, decides these from scratch and stores what came out differently (``repairs``).

Published rows stay as they are. ``settled`` reads decisions and repairs together: its rows are those of one load of
all messages, from which silver, audits and gold follow by the batch operators. The registry gets the row that turned
out to be the first of its id, the memory forgets older holders of the ids, and the counts per stage are corrected by
counts below zero, so that their sums are whole.

A batch without such rows reads no history. One with them reads the ids of ``decided`` and shuffles rows of theirs only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwell.operators import identity
from driftwell.operators.copies import ROW_ID
from driftwell.schemas import DECIDED, DECISION, RECORD
from driftwell.sources.tables import Tables
from driftwell.streaming.memory import ShortTermMemory

DECIDED_ROWS, REPAIRS = "decided", "repairs"


def out_of_order(records: DataFrame, memory: ShortTermMemory) -> DataFrame:
    """The distinct ids of rows that arrive before the horizon, or not after a holder of their id."""
    found = records.filter(memory.is_behind()).select("event_id")
    remembered = memory.remembered()
    if remembered is not None:
        holders = remembered.groupBy("event_id").agg(F.max("remembered_at").alias("held"))
        found = found.unionByName(records.join(holders, "event_id").filter("arrival_ts <= held").select("event_id"))
    return found.distinct()


def decide_again(tables: Tables, ids: DataFrame, batch_id: int) -> DataFrame:
    """All rows of ``ids`` up to the batch, decided from scratch, with their last decision as ``was``."""
    stored = _standing(tables, batch_id, batch_id - 1, ids)
    was = stored.select(*ROW_ID, _decision().alias("was"))
    return identity.decide_identity(stored.select(*RECORD.names)).join(was, ROW_ID)


def repairs(again: DataFrame) -> DataFrame:
    """The rows whose decision changed, with the route they had."""
    return again.filter(~_decision().eqNullSafe(F.col("was"))).withColumn("previous_route", F.col("was.route"))


def settled(tables: Tables) -> DataFrame:
    """Every valid record of the finished batches with its route and audit columns as they stand now."""
    last = max(tables.batches("finished"), default=-1)
    return _standing(tables, last, last)


def _decision() -> Column:
    return F.struct(*DECISION.names)


def _standing(tables: Tables, decided_to: int, repaired_to: int, ids: DataFrame | None = None) -> DataFrame:
    def stored(name: str, last: int) -> DataFrame:
        rows = tables.read(name).filter(F.col("batch_id") <= last)
        return rows if ids is None else rows.join(ids, "event_id", "left_semi")

    others = [n for n in DECIDED.names if n not in ROW_ID]
    newest = F.max_by(F.struct(*others), "batch_id").alias("newest")
    repaired = stored(REPAIRS, repaired_to).groupBy(*ROW_ID).agg(newest).select(*ROW_ID, "newest.*")
    kept = stored(DECIDED_ROWS, decided_to).join(repaired.select(*ROW_ID), ROW_ID, "left_anti")
    return kept.select(*DECIDED.names).unionByName(repaired.select(*DECIDED.names))
