"""Mixing sources to target weights by a low-discrepancy source schedule.

1. Every document gets a size (words) and a place in its source's shuffled order (by MD5 of its id);
   running sums turn places into word offsets, in two steps: within slices of the hash range, and over
   the slices' totals. No step sorts a whole source in one task.
2. A source's stream is cut into blocks of ``BLOCK`` words. Its target says how many blocks, in passes over
   the stream, the mix takes from it; the last one may be cut short, so that targets are met to the word.
3. Slot t of the schedule gets the golden-ratio point frac((t + 1/2) * phi); the points map through the
   cumulative need of the sources to a source, slots are ranked per source (within chunks of slots, and over
   the chunks' counts), and rank r takes block r modulo the source's blocks. The golden ratio spreads every
   source evenly over the schedule. A source gets ``SPARE`` slots more than needed; ranks beyond its need
   are left out.
4. Documents are joined with the blocks they overlap; their overlaps times how often a block is taken are
   the words taken of them.

Sizes count runs of anything but ASCII white space; null and empty texts have size 0 and are never taken.
A null source is a source of its own, the last one. Targets: weights 3, 1, 2 by code point order of the
sources share ``SHARE`` of all words; a target stops at ``MOST`` times its source's words and the excess is
shared again. Repeated rows each count. Ties of the hash go by id, size and text. Other columns are not read.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwell.session import materialize

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK = 256
SPARE = 16
SLICE_ROWS = 4096  # documents of all sources in a slice of the hash range
CHUNK = 1 << 16  # slots ranked together
CELLS = 4  # join cells per source
PHI = 0.6180339887498949
PHI_20 = (PHI * 2**20) % 1.0  # what 2**20 slots move the point by
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sized: DataFrame) -> DataFrame:
    """(source, number, source_size, target): one row per source; only source rows are ordered in one task."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    numbered = sources.withColumn("number", F.row_number().over(by_name) - 1)
    weighed = numbered.withColumn("weight", F.element_at(weights, F.col("number") % len(WEIGHTS) + 1))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # In order of how soon a source's cap binds: what is left for the others once the sources up to here are capped.
    order = [F.col("source_size") / F.col("weight"), F.col("number")]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    cap = MOST * F.col("source_size")
    left = SHARE * F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    filled = weighed.select("*", (left / open_weight).alias("level"), F.row_number().over(Window.orderBy(*order)).alias("turn"))
    fits = F.col("level") * F.col("weight") <= cap
    first_fit = F.min(F.when(fits, F.struct("turn", "level"))).over(everything)
    filled = filled.withColumn("fit", first_fit)
    capped = F.col("fit").isNull() | (F.col("turn") < F.col("fit.turn"))
    return filled.select(
        "source", "number", "source_size", F.when(capped, cap.cast("double")).otherwise(F.col("fit.level") * F.col("weight")).alias("target")
    )


def _placed(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Adds number, source_size, target and ``offset``, the first word of a document in its source's stream."""
    rows = sized.count()
    slices = max(1, rows // SLICE_ROWS)
    own = sized.alias("d").join(sources.alias("s"), F.expr("d.source <=> s.source")).select("d.*", "number", "source_size", "target")
    place = F.floor(F.conv(F.substring("shuffle_key", 1, 8), 16, 10).cast("long") * F.lit(slices) / F.lit(2**32))
    own = own.withColumn("slice", place)
    slice_sums = own.groupBy("number", "slice").agg(F.sum("size").alias("slice_size"))
    earlier = Window.partitionBy("number").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slice_sums = slice_sums.select("number", "slice", F.coalesce(F.sum("slice_size").over(earlier), F.lit(0)).alias("slice_start"))
    inside = Window.partitionBy("number", "slice").orderBy("shuffle_key", "doc_id", "size", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    placed = own.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return placed.join(slice_sums, ["number", "slice"]).withColumn("offset", F.col("slice_start") + F.col("inner")).drop("inner", "slice_start", "slice", "shuffle_key")


def needs(sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """Adds blocks in a source, slots needed, and words of the last slot (all of its block's, or fewer)."""
    words = F.floor("target").cast("long")
    size = F.greatest("source_size", F.lit(1))
    out = sources.filter("source_size > 0").withColumn("n_blocks", F.ceil(F.col("source_size") / block))
    rest = words % size
    return out.select(
        "number",
        "source_size",
        "n_blocks",
        (F.floor(words / size) * F.col("n_blocks") + F.ceil(rest / block)).alias("need"),
        F.when(rest > 0, (rest - 1) % block + 1).otherwise(block).alias("last_words"),
    )


def schedule(sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """(slot, number, rank, block, words): the mix as a sequence of equal-word blocks. ``words`` is the most the slot takes."""
    need = needs(sources, block)
    spare = need.withColumn("share", F.col("need") + SPARE)
    n_sources, total = need.count(), spare.agg(F.sum("share")).first()[0] or 0
    upto = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    cells = max(1, CELLS * n_sources)
    low = F.coalesce(F.sum("share").over(upto), F.lit(0))
    ranges = spare.select("*", (low / total).alias("low"), ((low + F.col("share")) / total).alias("high")) if total else spare.withColumns({"low": F.lit(0.0), "high": F.lit(0.0)})
    ranges = ranges.withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") * cells), F.floor(F.col("high") * cells))))
    spark = sources.sparkSession
    t = F.col("slot") + 0.5
    coarse = F.floor(F.col("slot") / 2**20)
    moved = coarse * PHI_20 + (t - coarse * 2**20) * PHI
    slots = spark.range(total).withColumnRenamed("id", "slot").withColumn("point", moved - F.floor(moved))
    slots = slots.withColumn("cell", F.floor(F.col("point") * cells))
    drawn = slots.join(ranges, "cell").filter("point >= low AND point < high").withColumn("chunk", F.floor(F.col("slot") / CHUNK))
    drawn = drawn.select("slot", "chunk", "number", "n_blocks", "need", "last_words")
    chunks = drawn.groupBy("number", "chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("number").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.select("number", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("ranked"))
    inner = F.row_number().over(Window.partitionBy("number", "chunk").orderBy("slot")) - 1
    ranked = drawn.withColumn("inner", inner).join(chunks, ["number", "chunk"]).withColumn("rank", F.col("ranked") + F.col("inner"))
    last = F.col("rank") == F.col("need") - 1
    return ranked.filter("rank < need").select(
        "slot", "number", "rank", (F.col("rank") % F.col("n_blocks")).alias("block"), F.when(last, F.col("last_words")).otherwise(block).alias("words")
    )


def mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, source, text_hash, size, source_size, target, taken."""
    sized = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{source}`").alias("source"),
        word_count(F.col(f"`{text}`")).alias("size"),
        F.xxhash64(F.col(f"`{text}`")).alias("text_hash"),
        F.md5(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).cast("binary")).alias("shuffle_key"),
    )
    sized = materialize(sized, "sized")
    sources = materialize(targets(sized), "targets")
    placed = materialize(_placed(sized, sources), "placed")
    takes = schedule(sources, block).groupBy("number", "block").agg(
        F.sum(F.when(F.col("words") == block, 1).otherwise(0)).alias("whole"), F.max(F.when(F.col("words") < block, F.col("words")).otherwise(0)).alias("part")
    )
    kept = ["doc_id", "source", "text_hash", "size", "source_size", "target"]
    some = placed.filter("size > 0")
    end = F.col("offset") + F.col("size")
    pieces = some.withColumn("block", F.explode(F.sequence(F.floor(F.col("offset") / block), F.floor((end - 1) / block))))
    start = F.col("block") * block

    def overlap(words: Column) -> Column:
        return F.greatest(F.least(end, start + words) - F.greatest(F.col("offset"), start), F.lit(0))

    taken = F.coalesce(overlap(F.lit(block)) * F.col("whole") + overlap(F.col("part")), F.lit(0))
    joined = pieces.join(takes, ["number", "block"], "left").withColumn("words", taken)
    # (source, offset) is a row's own: nothing else of some size starts there.
    used = joined.groupBy(*kept, "number", "offset").agg(F.sum("words").cast("long").alias("taken")).select(*kept, "taken")
    return used.union(placed.filter("size = 0").select(*kept, F.lit(0).cast("long").alias("taken")))


def apply_mix(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """The documents as often as the mix takes them, to the nearest whole: not at all, once or twice."""
    copies = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    mixed = mix(docs, text, doc_id, source).filter("taken > 0").withColumn("__mix_copies", copies)
    mixed = mixed.groupBy(F.col("doc_id").alias("__mix_id"), F.col("source").alias("__mix_source"), F.col("text_hash").alias("__mix_text")).agg(F.sum("__mix_copies").cast("int").alias("__mix_copies"))
    marked = docs.withColumn("__mix_hash", F.xxhash64(F.col(f"`{text}`")))
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col("__mix_id")) & F.col(f"`{source}`").eqNullSafe(F.col("__mix_source")) & (F.col("__mix_hash") == F.col("__mix_text"))
    rows = marked.join(mixed.filter("__mix_copies > 0").hint("shuffle_hash"), same).dropDuplicates([doc_id, source, "__mix_hash"])
    repeated = rows.withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_copies"))))
    return repeated.select(*[f"`{c}`" for c in docs.columns])
