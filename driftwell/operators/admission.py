"""Greedy admission: per event id, in arrival order, a row is admitted when nothing holds it back.

An admitted row holds back the rows of its id that arrive before it expires, and only then; being
held back renews nothing. Both identity windows work like this: the conflict memory expires a fixed
time after the holder's arrival, deduplication a fixed time after its event time. (A row that
arrives after its own expiry is admitted when nothing holds it, and holds nothing.)

Ids with few copies are folded as one small array. Ids with many copies are never gathered: every
possible holder gets a pointer to the next possible one, pointers are doubled until the chain from
the first holder is known, and rows find their holder by a join on time buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from driftwell.config import CONFLICT_TTL_SECONDS, FOLD_COPIES
from driftwell.operators.copies import Copies
from driftwell.operators.salting import every_salt, row_salt, salts_for
from driftwell.session import materialize

_BUCKET_MICROS = CONFLICT_TTL_SECONDS * 1_000_000
_SLICE_WIDTHS = [1_000_000, 3600 * 1_000_000, None]


def admit(rows: DataFrame, copies: Copies, fold_copies: int = FOLD_COPIES) -> DataFrame:
    """``rows`` of the repeated ids in ``copies`` plus ``holder_hash`` and ``admitted``.

    Needs the row id, ``payload_hash``, ``expires_at`` and ``copies``. A remembered holder
    of an earlier batch is a row with ``memory`` set: it comes first and is not returned.
    ``holder_hash`` is the hash of the holder a row is held by; an admitted row has its own.
    """
    few = _fold(rows.filter(F.col("copies") <= fold_copies))
    if copies.most <= fold_copies:
        return few
    return few.unionByName(_resolve_large(rows.filter(F.col("copies") > fold_copies), copies))


# -- ids with few copies -------------------------------------------------------------------------


def _fold(rows: DataFrame) -> DataFrame:
    carried = [c for c in rows.columns if c not in ("event_id", "arrival_ts", "arrival_seq")]
    ordered = F.array_sort(
        F.collect_list(
            F.struct(
                F.col("memory").isNull().alias("is_row"), "arrival_ts", "arrival_seq", *carried
            )
        )
    )
    gathered = rows.groupBy("event_id").agg(ordered.alias("group"))
    element = gathered.schema["group"].dataType.elementType.simpleString()
    start = F.expr(
        f"named_struct('until', cast(null as timestamp), 'hash', cast(null as string), 'out', "
        f"cast(array() as array<struct<row:{element},holder_hash:string,admitted:boolean>>))"
    )

    def step(state: Column, row: Column) -> Column:
        remembered = ~row["is_row"]
        free = remembered | state["until"].isNull() | (row["arrival_ts"] >= state["until"])
        holds = remembered | (free & (row["expires_at"] > row["arrival_ts"]))
        own_hash = F.coalesce(row["remembered_hash"], row["payload_hash"])
        return F.struct(
            F.when(holds, row["expires_at"]).otherwise(state["until"]).alias("until"),
            F.when(holds, own_hash).otherwise(state["hash"]).alias("hash"),
            F.concat(
                state["out"],
                F.array(
                    F.struct(
                        row.alias("row"),
                        F.when(free, own_hash).otherwise(state["hash"]).alias("holder_hash"),
                        free.alias("admitted"),
                    )
                ),
            ).alias("out"),
        )

    folded = gathered.select(
        "event_id", F.explode(F.aggregate("group", start, step, lambda s: s["out"])).alias("one")
    )
    return folded.filter("one.row.is_row").select(
        "event_id",
        *[F.col(f"one.row.{c}").alias(c) for c in ("arrival_ts", "arrival_seq", *carried)],
        "one.holder_hash",
        "one.admitted",
    )


# -- ids with many copies ------------------------------------------------------------------------


def _resolve_large(rows: DataFrame, copies: Copies) -> DataFrame:
    first_bucket = F.expr(f"unix_micros(holder.at) div {_BUCKET_MICROS}")
    last_bucket = F.expr(f"unix_micros(least(holder.until, last_arrival)) div {_BUCKET_MICROS}")
    last = rows.groupBy("event_id").agg(F.max("arrival_ts").alias("last_arrival"))
    # Holders are few per id and time. Each stands in every bucket it reaches that can have rows.
    spans = _holders(rows).join(last, "event_id").select(
        "event_id",
        F.col("holder.at").alias("from_ts"),
        F.col("holder.seq").alias("from_seq"),
        F.col("holder.until").alias("until"),
        F.col("holder.hash").alias("holder_hash"),
        F.explode(F.sequence(first_bucket, F.greatest(first_bucket, last_bucket))).alias("bucket"),
    )
    bucket = F.expr(f"unix_micros(arrival_ts) div {_BUCKET_MICROS}").alias("bucket")
    placed = rows.filter(F.col("memory").isNull()).drop("salts").select("*", bucket)
    placed, spans = _salt_hot_buckets(placed, spans, copies)
    placed, spans = placed.alias("r"), spans.alias("s")
    is_holder = (F.col("r.arrival_ts") == F.col("s.from_ts")) & (F.col("r.arrival_seq") == F.col("s.from_seq"))
    at_or_after = is_holder | (F.col("r.arrival_ts") > F.col("s.from_ts")) | (
        (F.col("r.arrival_ts") == F.col("s.from_ts")) & (F.col("r.arrival_seq") > F.col("s.from_seq"))
    )
    # Spans of one id never overlap, so a row meets at most one.
    on = (
        (F.col("r.event_id") == F.col("s.event_id"))
        & (F.col("r.bucket") == F.col("s.bucket"))
        & (F.col("r.salt") == F.col("s.salt"))
        & at_or_after
        & (F.col("r.arrival_ts") < F.col("s.until"))
    )
    found = placed.join(spans, on, "left").select(
        "r.*",
        F.coalesce("s.holder_hash", "r.payload_hash").alias("holder_hash"),
        (F.col("s.from_ts").isNull() | is_holder).alias("admitted"),
    )
    return found.withColumn("salts", salts_for(F.col("copies"), copies.hot_rows)).drop("bucket", "salt")


def _salt_hot_buckets(placed: DataFrame, spans: DataFrame, copies: Copies) -> tuple[DataFrame, DataFrame]:
    """A ``salt`` on both sides, above 0 only for buckets of one id with more rows than a salt holds.

    Like hot ids, such buckets number at most 10,000, which bounds the broadcast.
    """
    if copies.most <= copies.hot_rows:
        return placed.withColumn("salt", F.lit(0)), spans.withColumn("salt", F.lit(0))
    counted = placed.groupBy("event_id", "bucket").agg(F.count("*").alias("rows"))
    hot = counted.filter(F.col("rows") > copies.hot_rows).select(
        "event_id", "bucket", salts_for(F.col("rows"), copies.hot_rows).alias("salts")
    )
    hot = F.broadcast(materialize(hot, "hot-buckets"))

    def with_salts(df):
        return df.join(hot, ["event_id", "bucket"], "left").withColumn("salts", F.coalesce("salts", F.lit(1)))

    placed = with_salts(placed).select("*", row_salt("arrival_ts", "arrival_seq")).drop("salts")
    return placed, with_salts(spans).select("*", every_salt()).drop("salts")


def _holders(rows: DataFrame) -> DataFrame:
    """``event_id, holder(at, seq, until, hash)`` of every admitted row that holds others."""
    remembered = rows.filter(F.col("memory").isNotNull())
    earliest = rows.filter(F.col("memory").isNull()).groupBy("event_id").agg(F.min("arrival_ts").alias("first_ts"))
    # A remembered holder stands just before the id's first row, whatever its own arrival was.
    before = remembered.join(earliest, "event_id").select(
        "event_id",
        F.struct(
            F.expr("first_ts - interval 1 microsecond").alias("at"),
            F.lit(-1).cast("long").alias("seq"),
            F.col("expires_at").alias("until"),
            F.col("remembered_hash").alias("hash"),
        ).alias("node"),
    ).filter("node.until > node.at")
    point = F.struct(
        F.col("arrival_ts").alias("at"),
        F.col("arrival_seq").alias("seq"),
        F.col("expires_at").alias("until"),
        F.col("payload_hash").alias("hash"),
    )
    # Only the first row of an instant can hold, and only if it expires after that instant.
    blocking = rows.filter(F.col("memory").isNull() & (F.col("expires_at") > F.col("arrival_ts")))
    nodes = blocking.groupBy("event_id", F.col("arrival_ts").alias("at")).agg(F.min(point).alias("node")).drop("at")
    nodes = materialize(nodes.unionByName(before), "holders-possible")

    first = nodes.groupBy("event_id").agg(F.min("node").alias("node"))
    queries = nodes.select("event_id", F.col("node.until").alias("at")).distinct()
    following = materialize(next_at_or_after(nodes, queries), "holders-next")

    # hop: from the moment a holder expires to the moment the next holder does.
    hop = following.select("event_id", "at", F.col("node.until").alias("to"))
    reached = first.select("event_id", F.col("node.until").alias("at"))
    while not hop.isEmpty():
        onward = reached.join(hop, ["event_id", "at"]).select("event_id", F.col("to").alias("at"))
        reached = materialize(reached.unionByName(onward), "holders-reached")
        second = hop.select("event_id", F.col("at").alias("to"), F.col("to").alias("then"))
        hop = materialize(
            hop.join(second, ["event_id", "to"]).select("event_id", "at", F.col("then").alias("to")),
            "holders-hop",
        )
    later = reached.join(following, ["event_id", "at"]).select("event_id", "node")
    return first.unionByName(later).withColumnRenamed("node", "holder")


def _slice_number(moment: str, width: int) -> Column:
    micros = F.unix_micros(moment)
    return ((micros - F.pmod(micros, F.lit(width))) / width).cast("long")


def next_at_or_after(nodes: DataFrame, queries: DataFrame, widths=None) -> DataFrame:
    """For each ``(event_id, at)`` the id's earliest ``node`` with ``node.at >= at``, if any.

    Time is cut into slices, so one task sees one slice of one id (at most a million distinct
    microseconds). A query with nothing left in its slice asks again among the first nodes of the
    slices, in wider slices; the last level sees one node per hour.
    """
    width, *wider = _SLICE_WIDTHS if widths is None else widths
    pieces = ["event_id"] if width is None else ["event_id", "slice"]

    def sliced(df: DataFrame, moment: str) -> DataFrame:
        return df if width is None else df.withColumn("slice", _slice_number(moment, width))

    empty = F.lit(None).cast(nodes.schema["node"].dataType)
    points = sliced(nodes.select("event_id", F.col("node.at").alias("at"), "node"), "at")
    asked = sliced(queries.select("event_id", "at"), "at").withColumn("node", empty)
    # Walking back in time, a point comes before a query of the same instant.
    backwards = W.partitionBy(*pieces).orderBy(F.col("at").desc(), F.col("node").isNull())
    seen = F.last("node", ignorenulls=True).over(backwards.rowsBetween(W.unboundedPreceding, W.currentRow))
    answered = (
        points.withColumn("asks", F.lit(False))
        .unionByName(asked.withColumn("asks", F.lit(True)))
        .withColumn("found", seen)
        .filter("asks")
    )
    direct = answered.filter(F.col("found").isNotNull()).select("event_id", "at", F.col("found").alias("node"))
    if width is None:
        return direct
    slice_end = F.expr(f"timestamp_micros((slice + 1) * {width})")
    open_queries = answered.filter(F.col("found").isNull()).select("event_id", "at", slice_end.alias("end"))
    slice_firsts = points.groupBy(*pieces).agg(F.min("node").alias("node")).drop("slice")
    asked_next = open_queries.select("event_id", F.col("end").alias("at")).distinct()
    later = next_at_or_after(slice_firsts, asked_next, wider).withColumnRenamed("at", "end")
    return direct.unionByName(open_queries.join(later, ["event_id", "end"]).select("event_id", "at", "node"))


