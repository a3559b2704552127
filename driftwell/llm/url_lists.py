"""URL filter by dated lists: validity intervals and an as-of join at the time of fetch.

List entries (key, action, since) say from when on a key is to ``block``, ``allow`` or ``remove``; a key is a host,
a parent domain, or a host with leading path segments. The next entry of the same key ends an entry's validity.
A capture (url, time) is judged by its most specific key with a valid entry that isn't ``remove``: paths before
hosts, longer before shorter.

The as-of join cuts time into slices of an hour, but only where captures of the key are (*cells*). The entry valid at
a cell's start is found first, among the key's entries and cell starts alone; then entries and captures of a cell are
sorted together and each capture sees the last entry before it. So what an interval costs follows the captures and
entries, not the span of time, and no pair is made. A cell with more than ``HOT_ROWS`` captures is cut into
parts by a salt, with the cell's entries in each part. Equal captures are judged once.

Of entries of one key and instant the one whose action comes first in block, allow, remove wins; repeated entries
count once. Entries with a null in any field are ignored. Captures without a URL, a host or a time get the verdict
``unknown``, those without a valid entry ``none``. URLs of any length are fine (captures get keys
of as many path segments as the deepest entry has, counted first);
hosts are compared in lower case without port and final dot. Other columns of any name are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwell.operators.salting import every_salt, salts_for
from driftwell.session import materialize

PATH_DEPTH = 2
SLICE_SECONDS = 3600
HOT_ROWS = 500_000
ACTIONS = ("remove", "allow", "block")


def host(url: Column) -> Column:
    """Lower-case host of an absolute URL, or null."""
    name = F.lower(F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@\s]+)", 1))
    return F.nullif(F.regexp_replace(name, r"\.$", ""), F.lit(""))


def path(url: Column) -> Column:
    """The path without query and fragment, or ''."""
    return F.coalesce(F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1), F.lit(""))


def keys(url: Column, depth: int = PATH_DEPTH) -> Column:
    """Array of struct(rank, key), the greater rank the more specific; null without a host."""
    name = host(url)
    labels = F.split(name, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda n: F.struct(n.alias("rank"), F.array_join(F.slice(labels, -n, n), ".").alias("key")),
    )
    segments = F.slice(F.filter(F.split(path(url), "/"), lambda s: s != ""), 1, depth)
    paths = F.transform(
        segments, lambda _, i: F.struct((F.size(labels) + i + 1).alias("rank"), F.concat(name, F.lit("/"), F.array_join(F.slice(segments, F.lit(1), i + 1), "/")).alias("key"))
    )
    return F.when(name.isNotNull(), F.concat(domains, paths))


def deepest(entries: DataFrame) -> int:
    """The most path segments that a key of ``entries`` has."""
    segments = F.size(F.split("key", "/")) - 1
    return max(0, entries.agg(F.max(segments).alias("depth")).first()["depth"] or 0)


def intervals(entries: DataFrame) -> DataFrame:
    """(key, action, valid_from, valid_to) of entries (key, action, since); ``valid_to`` is exclusive, null while open."""
    order = F.array(*[F.lit(a) for a in ACTIONS])
    known = entries.select("key", "action", "since").na.drop().withColumn("weight", F.array_position(order, F.col("action"))).filter("weight > 0")
    single = known.groupBy("key", "since").agg(F.max("weight").alias("weight"))
    until = F.lead("since").over(Window.partitionBy("key").orderBy("since"))
    return single.select("key", F.element_at(order, F.col("weight").cast("int")).alias("action"), F.col("since").alias("valid_from"), until.alias("valid_to"))


def _slice(time: Column) -> Column:
    return F.floor(F.unix_seconds(time) / SLICE_SECONDS)


def _cells(captures: DataFrame, hot_rows: int) -> DataFrame:
    """(key, slice, salts): where captures are, and into how many parts to cut them."""
    counts = captures.groupBy("key", _slice(F.col("fetched_at")).alias("slice")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("key", "slice", salts_for(F.col("n"), hot_rows).alias("salts"))


def _listed(valid: DataFrame, cells: DataFrame) -> DataFrame:
    """(key, slice, salt, time, entry): the entries that the captures of a cell can see, in each of its parts."""
    entry = F.struct("action", "valid_from")
    starts = cells.select("key", F.timestamp_seconds(F.col("slice") * SLICE_SECONDS).alias("time"), F.lit(None).cast("struct<action:string,valid_from:timestamp>").alias("entry"), F.struct("slice", "salts").alias("cell"))
    known = valid.select("key", F.col("valid_from").alias("time"), entry.alias("entry"), F.lit(None).cast(starts.schema["cell"].dataType).alias("cell"))
    # Entries sort before a cell that starts at the same instant.
    order = Window.partitionBy("key").orderBy("time", F.col("cell").isNotNull())
    carried = known.unionByName(starts).withColumn("entry", F.last("entry", ignorenulls=True).over(order)).filter("cell IS NOT NULL AND entry IS NOT NULL")
    inside = valid.select("key", _slice(F.col("valid_from")).alias("slice"), F.col("valid_from").alias("time"), entry.alias("entry")).join(cells, ["key", "slice"])
    seen = carried.select("key", "cell.slice", "time", "entry", "cell.salts").unionByName(inside)
    return seen.select("key", "slice", every_salt(), "time", "entry")


def as_of(captures: DataFrame, valid: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Adds action and valid_from, those valid at ``fetched_at`` for ``key``, to captures (key, fetched_at, ...).

    The intervals of a key have to follow each other without gaps, as those of ``intervals`` do.
    """
    cells = materialize(_cells(captures, hot_rows), "cells")
    listed = _listed(valid, cells)
    listed = listed.withColumn("capture", F.lit(None).cast(captures.select(F.struct("*")).schema[0].dataType))
    # Hot cells are at most captures / ``hot_rows``; written, so that Spark joins them by their real size.
    hot = materialize(cells.filter("salts > 1").select(F.col("key").alias("__key"), F.col("slice").alias("__slice"), "salts"), "hot")
    placed = captures.select("key", _slice(F.col("fetched_at")).alias("slice"), F.col("fetched_at").alias("time"), F.struct("*").alias("capture"))
    asked = placed.join(hot, (F.col("key") == F.col("__key")) & (F.col("slice") == F.col("__slice")), "left")
    salt = F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64("capture"), F.col("salts"))).cast("int")
    asked = asked.select("key", "slice", salt.alias("salt"), "time", F.lit(None).cast(listed.schema["entry"].dataType).alias("entry"), "capture")
    # Entries sort before captures of the same instant; a carried one before those that begin at the cell's start.
    order = Window.partitionBy("key", "slice", "salt").orderBy("time", F.col("capture").isNotNull(), F.col("entry.valid_from"))
    seen = listed.unionByName(asked).withColumn("entry", F.last("entry", ignorenulls=True).over(order)).filter("capture IS NOT NULL")
    return seen.select("capture.*", F.col("entry.action").alias("action"), F.col("entry.valid_from").alias("valid_from"))


def judge(captures: DataFrame, entries: DataFrame, url: str = "url", fetched_at: str = "fetched_at", out: str = "url_verdict") -> DataFrame:
    """Adds ``out``: struct(verdict, key, since)."""
    url_, at_ = F.col(f"`{url}`"), F.col(f"`{fetched_at}`")
    entries = materialize(entries.select("key", "action", "since"), "entries")
    distinct = captures.select(url_.alias("url"), at_.cast("timestamp").alias("fetched_at")).na.drop().distinct()
    asked = distinct.select("url", "fetched_at", F.inline(keys(F.col("url"), deepest(entries))))
    found = as_of(asked, intervals(entries)).filter("action <> 'remove'")
    best = found.groupBy(F.col("url").alias("__url"), F.col("fetched_at").alias("__fetched_at")).agg(F.max(F.struct("rank", "action", "key", "valid_from")).alias("__best"))
    joined = captures.join(best, (url_ == F.col("__url")) & (at_.cast("timestamp") == F.col("__fetched_at")), "left")
    unknown = host(url_).isNull() | at_.isNull()
    verdict = F.when(unknown, "unknown").otherwise(F.coalesce(F.col("__best.action"), F.lit("none")))
    result = F.struct(verdict.alias("verdict"), F.col("__best.key").alias("key"), F.col("__best.valid_from").alias("since"))
    return joined.withColumn("__verdict", result).drop("__url", "__fetched_at", "__best").withColumn(out, F.col("__verdict")).drop("__verdict")
