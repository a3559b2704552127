"""A batch's outcome and latency totals, observed while its rows are written: no pass over the rows for them.

The observed rows are written by tasks of a result stage, whose metrics count once however often a task is tried.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from driftwell.operators import identity
from driftwell.operators.quality import latency_of


def _outcome(stage: str, route: str, met: Column) -> Column:
    return F.count_if(met).alias(f"{stage}/{route}")


def message_totals() -> list[Column]:
    """Of every message: parsing and validation outcomes, and the latency of the valid ones."""
    route = F.col("route")
    latency = F.when(route == "valid", latency_of())
    return [
        _outcome("parsing", "valid", route != "unparsed"),
        _outcome("parsing", "invalid", route == "unparsed"),
        _outcome("validation", "valid", route == "valid"),
        _outcome("validation", "invalid", route == "invalid"),
        F.count(latency).alias("events"),
        F.sum(latency).alias("sum_ms"),
        F.min(latency).alias("min_ms"),
        F.max(latency).alias("max_ms"),
    ]


def identity_totals() -> list[Column]:
    """Of every valid record: the outcomes of the identity stages."""
    route = F.col("route")
    decided = [_outcome("registry", r, route == r) for r in (identity.NEW, identity.REPLAY, identity.CONFLICT)]
    short, double = route == identity.SHORT_CONFLICT, route == identity.DUPLICATE
    return [
        _outcome("conflict_check", "conflict", short),
        _outcome("conflict_check", "clean", ~short),
        _outcome("deduplication", "dropped", double),
        _outcome("deduplication", "kept", ~short & ~double),
        *decided,
    ]


def outcome_rows(observed: dict) -> list[tuple[str, str, int]]:
    """``(stage, route, events)`` of the outcomes that occurred."""
    return [(*name.split("/"), count) for name, count in observed.items() if "/" in name and count]


def latency_row(observed: dict) -> list[tuple]:
    """``(events, sum_ms, min_ms, max_ms)``; none without a valid message."""
    return [tuple(observed[n] for n in ("events", "sum_ms", "min_ms", "max_ms"))] if observed["events"] else []
