"""Near duplicates by BagMinHash: weighted-Jaccard signatures of word-shingle multisets, bands, verification.

1. Every text becomes its multiset of five-word shingles, its BagMinHash signature and band keys, in one
   pass (numpy in an Arrow UDF). Texts with equal word sequences are one *node*: copies, however many, are
   merged by a partial aggregate before anything else.
2. Nodes that share a band key are candidates. Each bucket compares its members with one hub, its most
   central member (the one with most company in all its buckets), not with each other; the verified links are
   joined into components, which settles nearly all of a group of near copies. What is left are pairs of a
   bucket's members in different components. They are compared too, so that no candidate link between
   components is lost: first those whose signatures are close, then, between components that are still
   apart, all whose similarities to the bucket's hub allow a link and whose signatures do. For these the
   members left get a second signature of ``FINE`` registers, which tells pairs at 0.8 from pairs at 0.75
   (four bits of a register are compared; 3 of 10,000 pairs at 0.8 differ in more registers than
   ``MOST_DIFFERENT`` allows). The join makes each pair once, in the first bucket both share.
3. A link counts if the exact weighted Jaccard similarity of the two whole texts is at least ``threshold``.

Words are compared in lower case, by ASCII white space. Null and empty texts and texts of white space are
copies of one another (no words); a text under five words has one shingle. Repeated rows are copies. A
class's id is its smallest doc_id (null if it has only null ids). Texts of any length are fine. Other
columns are not read; an empty table gives no rows. At 0.8, 20 bands of 4 registers miss a pair in 3 of 100,000
cases; a lower ``threshold`` is refused, as bands and sketches would lose links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwell.llm.bagminhash import REGISTERS, band_keys, signatures, sketches
from driftwell.llm.codes import runs, small_batches
from driftwell.llm.components import components, merged
from driftwell.llm.shingles import WORDS, multisets, shingle_hashes, text_keys, weighted_jaccard, word_hashes
from driftwell.operators.salting import every_salt, row_salt, salts_for
from driftwell.session import materialize, scratch

BANDS = 20
THRESHOLD = 0.8
ROWS = 4  # registers in a band; the others serve the comparison of signatures only
SKETCH_WORDS = 4  # of 40 registers, each in four longs
FINE = 1024  # registers of the second signature
CLOSE = 26  # most registers of 160 that differ in the first round; at a similarity of 0.8 they are 30 on average
MOST_DIFFERENT = (50, 236)  # the same in the second round, of 160 and of FINE; at 0.8 they are 30 and 192 on average
RUN_CHARS = 1 << 20
TEXT_KEYS = ["k1", "k2"]
ROW_KEYS = ["__near_id", "__near_no_id", "__near_hash"]
HUB_ROWS = 2_000  # pairs of one hub that are verified in one place


def _signed(df: DataFrame, text: str, words: int, bands: int) -> DataFrame:
    """Adds ``signed``: struct of the text's two keys, its band keys (none for a text without words) and sketch."""
    small_batches(df.sparkSession)

    @F.arrow_udf("struct<k1:long,k2:long,bands:array<long>,sketch:array<long>>")
    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            first, second, keys, counts, shown = [], [], [np.empty(0, np.int64)], [np.zeros(1, np.int64)], [np.empty(0, np.int64)]
            for texts in runs(batch.to_pylist(), RUN_CHARS):
                hashes, starts = word_hashes(texts)
                k1, k2 = text_keys(hashes, starts)
                owner, shingles, weights = multisets(*shingle_hashes(hashes, starts, words))
                signature = signatures(owner, shingles, weights, len(texts), REGISTERS)
                found = band_keys(signature[:, : bands * ROWS], bands).view(np.int64)
                shown.append(sketches(signature).view(np.int64).reshape(-1))
                some = np.diff(starts) > 0
                first.append(k1.view(np.int64))
                second.append(k2.view(np.int64))
                keys.append(found[some].reshape(-1))
                counts.append(np.where(some, bands, 0))
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(counts)).astype(np.int32)), pa.array(np.concatenate(keys)))
            none = np.empty(0, np.int64)
            sketch = pa.ListArray.from_arrays(pa.array(np.arange(0, 16 * len(batch) + 1, 16, dtype=np.int32)), pa.array(np.concatenate(shown)))
            columns = [pa.array(np.concatenate([none, *first])), pa.array(np.concatenate([none, *second])), lists, sketch]
            yield pa.StructArray.from_arrays(columns, names=["k1", "k2", "bands", "sketch"])

    return df.withColumn("signed", sign(F.col(text)))


def _fine_sketches(texts: DataFrame, words: int) -> DataFrame:
    """(node, fine): sketches of ``FINE`` registers."""
    small_batches(texts.sparkSession)
    longs = FINE // 16  # 64 registers in four longs

    @F.arrow_udf("array<long>")
    def sketch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            made = [np.empty(0, np.int64)]
            for some in runs(batch.to_pylist(), RUN_CHARS):
                owner, shingles, weights = multisets(*shingle_hashes(*word_hashes(some), words))
                found = sketches(signatures(owner, shingles, weights, len(some), FINE), words=FINE // 64)
                made.append(found.view(np.int64).reshape(-1))
            starts = pa.array(np.arange(0, longs * len(batch) + 1, longs, dtype=np.int32))
            yield pa.ListArray.from_arrays(starts, pa.array(np.concatenate(made)))

    return materialize(texts.select("node", sketch("text").alias("fine")), "fine")


def _similarity(words: int):
    @F.arrow_udf("double")
    def similarity(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in batches:
            out = [np.empty(0)]
            a, b, size, at = left.to_pylist(), right.to_pylist(), 0, 0
            for i in range(len(a)):
                size += len(a[i] or "") + len(b[i] or "")
                if size >= RUN_CHARS or i + 1 == len(a):
                    out.append(weighted_jaccard([t or "" for t in a[at : i + 1]], [t or "" for t in b[at : i + 1]], words))
                    size, at = 0, i + 1
            yield pa.array(np.concatenate(out))

    return similarity


def _compared(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """The pairs (a, b) with their similarity. b may be the hub of very many: its rows are salted."""
    salts = pairs.groupBy("b").agg(salts_for(F.count(F.lit(1)), HUB_ROWS).alias("salts"))
    salted = pairs.join(salts, "b").select("a", "b", row_salt("a"))
    hubs = texts.join(salts, texts.node == salts.b).select("b", F.col("text").alias("text_b"), every_salt())
    both = salted.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(hubs, ["b", "salt"])
    return materialize(both.select("a", "b", _similarity(words)("text_a", "text_b").alias("similarity")), "compared")


def _differ(sketch: str, words: int) -> str:
    """SQL for the number of registers in which two sketches of ``words`` words differ."""
    planes = [[f"({sketch}_a[{4 * w + p}] ^ {sketch}_b[{4 * w + p}])" for p in range(4)] for w in range(words)]
    return " + ".join(f"bit_count({' | '.join(p)})" for p in planes)


def _remaining(unsettled: DataFrame, nodes: DataFrame, most_different: dict[str, tuple[int, int]], threshold: float) -> DataFrame:
    """Pairs (a, b) of members of different components, with these, each from the first bucket that both are in.

    ``most_different`` has, for each column of sketches, its words of registers and how many registers may differ.
    One minus the similarity is a metric: two nodes whose similarities to the bucket's hub are further apart than
    one minus the threshold can't be linked.
    """
    members = unsettled.join(nodes, "node")
    carried = ("node", "component", "to_hub", "bands", *most_different)
    left, right = (members.select("key", *[F.col(c).alias(f"{c}_{n}") for c in carried]) for n in "ab")
    in_reach = F.abs(F.col("to_hub_a") - F.col("to_hub_b")) <= 1 - threshold + 1e-9
    first_shared = F.array_min(F.array_intersect("bands_a", "bands_b")) == left["key"]
    met = (left["key"] == right["key"]) & (F.col("component_a") < F.col("component_b")) & in_reach
    for sketch, (sketch_words, most) in most_different.items():
        met &= F.expr(f"{_differ(sketch, sketch_words)} <= {most}")
    return left.join(right, met & first_shared).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), "component_a", "component_b")


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD, words: int = WORDS, bands: int = BANDS
) -> DataFrame:
    """One row per document: doc_id, text_hash, class_id, class_size, is_kept.

    ``is_kept`` marks the rows that stand for their class: those with its smallest (doc_id, text_hash).
    """
    if threshold < THRESHOLD or bands < BANDS:
        raise ValueError(f"bands and sketches are laid out for similarities of {THRESHOLD} or more")
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    with scratch(docs.sparkSession) as keep:
        return keep(_classes(own.withColumn("text_hash", F.xxhash64("text")), threshold, words, bands), "classes")


def _row_keys(doc_id: str, text_hash: str) -> list[Column]:
    """Plain columns that tell (doc_id, text_hash) apart, nulls included, so that a grouping and a join by them share a shuffle."""
    return [F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("__near_id"), F.isnull(doc_id).alias("__near_no_id"), F.col(text_hash).alias("__near_hash")]


def _classes(own: DataFrame, threshold: float, words: int, bands: int) -> DataFrame:
    signed = _signed(own, "text", words, bands).select(
        "doc_id", "text_hash", "signed.*"
    )
    signed = materialize(signed, "signed")
    nodes = signed.groupBy(*TEXT_KEYS).agg(
        F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "text_hash")).alias("least"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")
    )
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")  # short ids, fixed by the table

    buckets = nodes.select("node", F.explode("bands").alias("key"))
    sizes = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    shared = materialize(buckets.join(sizes, "key"), "shared")
    company = shared.groupBy("node").agg(F.sum("members").alias("company"))
    placed = shared.select("key", "node").join(company, "node")
    hubs = placed.groupBy("key").agg(F.max(F.struct("company", "node")).alias("top")).select("key", F.col("top.node").alias("hub"))
    crowded = materialize(placed.join(hubs, "key").select("key", "node", "hub"), "crowded")

    wanted = crowded.select("node").distinct().join(nodes, "node").select("node", "least.*")
    found = own.select(*_row_keys("doc_id", "text_hash"), "text").join(wanted.select(*_row_keys("doc_id", "text_hash"), "node").hint("shuffle_hash"), ROW_KEYS)
    texts = materialize(found.select("node", "text").dropDuplicates(["node"]), "texts")  # repeated rows of the few that are left

    hub_pairs = crowded.filter("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    to_hubs = _compared(hub_pairs, texts, words)
    is_link = F.col("similarity") >= threshold
    joined = materialize(components(to_hubs.filter(is_link)), "joined")
    measured = crowded.join(to_hubs.toDF("node", "hub", "similarity"), ["node", "hub"], "left")
    measured = materialize(measured.select("key", "node", F.coalesce("similarity", F.lit(1.0)).alias("to_hub")), "measured")
    own_component = F.coalesce("component", "node")
    for close_first in (True, False):
        labelled = measured.join(joined, "node", "left").select("key", "node", "to_hub", own_component.alias("component"))
        split = labelled.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most")).filter("least <> most")
        unsettled = labelled.join(split.select("key"), "key")
        sketched = nodes.select("node", "bands", "sketch")
        most_different = {"sketch": (SKETCH_WORDS, CLOSE if close_first else MOST_DIFFERENT[0])}
        if not close_first:
            left_over = texts.join(unsettled.select("node").distinct().hint("shuffle_hash"), "node", "left_semi")
            sketched = sketched.join(_fine_sketches(left_over, words), "node")
            most_different["fine"] = (FINE // 64, MOST_DIFFERENT[1])
        pairs = materialize(_remaining(unsettled, sketched, most_different, threshold), "remaining")
        if not pairs.isEmpty():
            more = _compared(pairs.select("a", "b"), texts, words).filter(is_link).join(pairs, ["a", "b"])
            joined = merged(joined, more.select(F.col("component_a").alias("a"), F.col("component_b").alias("b")))

    grouped = nodes.select("node", *TEXT_KEYS, "least", "copies").join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    classes = grouped.groupBy("component").agg(F.min("least").alias("class_least"), F.sum("copies").alias("class_size"))
    verdicts = grouped.select(*TEXT_KEYS, "component").join(classes, "component").select(*TEXT_KEYS, "class_least", F.col("class_least.doc_id").alias("class_id"), "class_size")
    is_kept = F.struct("doc_id", "text_hash").eqNullSafe(F.struct("class_least.doc_id", "class_least.text_hash"))
    return signed.select("doc_id", "text_hash", *TEXT_KEYS).join(verdicts, TEXT_KEYS).select("doc_id", "text_hash", "class_id", "class_size", is_kept.alias("is_kept"))


def drop_near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, one of each class of near duplicates; all its columns.

    Whole rows stream through the join with the kept keys. Only kept rows that the table holds more than once
    are grouped, from a table of their own.
    """
    kept = near_duplicates(docs, text, doc_id, threshold).filter("is_kept").groupBy(*_row_keys("doc_id", "text_hash")).agg(F.count(F.lit(1)).alias("__near_rows"))
    marked = docs.withColumn("__near_text_hash", F.xxhash64(F.col(f"`{text}`")))
    keyed = marked.select(*_row_keys(f"`{doc_id}`", "__near_text_hash"), *[F.col(f"`{c}`") for c in docs.columns])
    once, repeated = (kept.filter(held) for held in ("__near_rows = 1", "__near_rows > 1"))
    rows = keyed.join(once.hint("shuffle_hash"), ROW_KEYS)
    if not repeated.isEmpty():
        rows = rows.union(materialize(keyed.join(repeated.hint("shuffle_hash"), ROW_KEYS), "repeated").dropDuplicates(ROW_KEYS))
    return rows.drop(*ROW_KEYS, "__near_rows")
