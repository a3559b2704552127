"""The stages wired together for a bounded set of messages."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from driftwell.operators import dead_letters as letters
from driftwell.operators import identity, quality, totals, windows
from driftwell.operators.fingerprint import fingerprint
from driftwell.operators.parse import parse_messages, parser_dead_letters
from driftwell.operators.validate import (
    telemetry,
    validate,
    validate_all,
    validator_dead_letters,
)
from driftwell.session import materialize


class TelemetryFlow:
    """Every intermediate of the flow as a DataFrame.

    All are lazy. Stages that are read several times (identity, counts) start from ``checked``, which
    is written once to the shared folder, so messages are parsed a single time.
    """

    def __init__(
        self, messages: DataFrame, as_of: Column | None = None, registry: DataFrame | None = None, watch: Observation | None = None
    ):
        self.messages = messages
        self.watch = watch
        self.as_of = as_of
        self.registry = registry

    @cached_property
    def parsed(self) -> DataFrame:
        return parse_messages(self.messages)

    @cached_property
    def validated(self) -> DataFrame:
        return validate(self.parsed, self.as_of)

    @cached_property
    def parser_letters(self) -> DataFrame:
        return parser_dead_letters(self.parsed)

    @cached_property
    def validator_letters(self) -> DataFrame:
        return validator_dead_letters(self.validated)

    @cached_property
    def dead_letters(self) -> DataFrame:
        return self.letters_by_stage.select("value")

    @cached_property
    def letters_by_stage(self) -> DataFrame:
        return letters.letters_by_stage(validate_all(self.parsed, self.as_of))

    @cached_property
    def telemetry(self) -> DataFrame:
        return telemetry(self.validated)

    @cached_property
    def fingerprinted(self) -> DataFrame:
        return fingerprint(self.telemetry)

    @cached_property
    def checked(self) -> DataFrame:
        """Every message once, with its route and fingerprint; the text only of rejected ones."""
        everything = fingerprint(validate_all(self.parsed, self.as_of))
        valid = F.col("route") == "valid"
        kept = everything.withColumn("message", F.when(~valid, F.col("message"))).withColumn(
            "payload_hash", F.when(valid, F.col("payload_hash"))
        )
        if self.watch is not None:
            kept = kept.observe(self.watch, *totals.message_totals())
        return materialize(kept, "checked")

    @cached_property
    def accepted(self) -> DataFrame:
        return self.checked.filter(F.col("route") == "valid").drop("message", "errors", "route")

    @cached_property
    def conflict_checked(self) -> DataFrame:
        return identity.detect_conflicts(self.accepted)

    @cached_property
    def clean(self) -> DataFrame:
        plain = self.accepted.columns
        return self.conflict_checked.filter(F.col("route") == "clean").select(*plain)

    @cached_property
    def routed(self) -> DataFrame:
        return identity.decide_identity(self.accepted, self.registry).drop("conflict_holder", "dedup_holder")

    @cached_property
    def deduplicated(self) -> DataFrame:
        kept = self.routed.filter(~F.col("route").isin(identity.SHORT_CONFLICT, identity.DUPLICATE))
        return kept.select(*self.accepted.columns)

    @cached_property
    def new(self) -> DataFrame:
        return self.routed.filter(F.col("route") == identity.NEW).select(*self.accepted.columns)

    @cached_property
    def windowed(self) -> DataFrame:
        return windows.assign_window(self.new)

    @cached_property
    def stage_routes(self) -> DataFrame:
        """``arrival_ts, stage, route`` of every decision taken on a message."""
        return message_routes(self.checked).unionByName(identity_routes(self.routed))

    @cached_property
    def stage_counts(self) -> DataFrame:
        return quality.stage_counts(self.stage_routes)


def message_routes(checked: DataFrame) -> DataFrame:
    """The parsing and validation stages of one message, in one pass."""
    unparsed = F.col("route") == "unparsed"
    stages = F.array(
        F.struct(
            F.lit("parsing").alias("stage"), F.when(unparsed, "invalid").otherwise("valid").alias("route")
        ),
        F.when(~unparsed, F.struct(F.lit("validation").alias("stage"), F.col("route").alias("route"))),
    )
    return _taken(checked, stages)


def identity_routes(routed: DataFrame) -> DataFrame:
    """The identity stages of one record, in one pass: each record stops at its last stage."""
    route = F.col("route")
    stages = F.array(
        F.struct(
            F.lit("conflict_check").alias("stage"),
            F.when(route == identity.SHORT_CONFLICT, "conflict").otherwise("clean").alias("route"),
        ),
        F.when(
            route != identity.SHORT_CONFLICT,
            F.struct(
                F.lit("deduplication").alias("stage"),
                F.when(route == identity.DUPLICATE, "dropped").otherwise("kept").alias("route"),
            ),
        ),
        F.when(
            route.isin(identity.NEW, identity.REPLAY, identity.CONFLICT),
            F.struct(F.lit("registry").alias("stage"), route.alias("route")),
        ),
    )
    return _taken(routed, stages)


def _taken(routed: DataFrame, stages: Column) -> DataFrame:
    taken = routed.select("arrival_ts", F.explode(stages).alias("taken")).filter(F.col("taken").isNotNull())
    return taken.select("arrival_ts", F.col("taken.stage").alias("stage"), F.col("taken.route").alias("route"))
