"""Document fingerprints: a Merkle tree over sections, paragraphs and pieces, in SQL expressions only.

A text's sections are parted by blank lines, its paragraphs by line feeds, a paragraph's pieces by content:
a piece ends after sentence punctuation or after a word that ends in ``n`` or ``s``, and has at most 256 code
points, so an edit changes the pieces around it and the later ones fall into step again. A node's digest is
the SHA-256 of its children's digests; equal roots mean equal trees.

The fingerprint is one string: ``root/section;section`` with each section as its digest (16 hex digits),
``:``, and its paragraphs joined by ``,``, each as its digest (16 hex digits), ``=``, and the first eight
digits of every piece. So two fingerprints tell which sections, paragraphs and pieces differ.
Likeness of two fingerprints is the Dice coefficient of their sets of pieces (1 if the roots are equal).

A null text counts as empty. An empty text has one section, paragraph and piece, all empty. Texts of any
length, repeated rows, null ids and other columns of any name are fine. Nothing is ordered in one task:
neighbours by id are found within ranges of ids, and a range's first row is copied to the range before.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwell.llm.expressions import bind

SECTION_BREAK = r"\n(?:[ \t]*\n)+"
#: The lazy run up to a cut or the paragraph's end; a run without one is cut at 256.
PIECE = r"(?s).{1,256}?(?:[ns][.,;]?[ \t]+|[.!?。！？]+[ \t]*|\z)|.{1,256}"
DIGITS, PIECE_DIGITS = 16, 8
RANGES_PER_PARTITION = 4


def fingerprint(text: Column) -> Column:
    """The fingerprint string of a text column."""

    def paragraph(value: Column) -> Column:
        found = F.regexp_extract_all(value, F.lit(PIECE), F.lit(0))
        pieces = F.transform(F.when(value == "", F.array(F.lit(""))).otherwise(found), lambda p: F.sha2(p, 256))

        def node(digests: Column) -> Column:
            short = F.array_join(F.transform(digests, lambda d: F.substring(d, 1, PIECE_DIGITS)), "")
            return _node(F.array_join(digests, ""), "=", short)

        return bind(pieces, node)

    def section(value: Column) -> Column:
        paragraphs = F.transform(F.split(value, r"\n", -1), paragraph)
        return bind(paragraphs, lambda p: _node(F.array_join(p["digest"], ""), ":", F.array_join(p["shown"], ",")))

    sections = F.transform(F.split(F.coalesce(text, F.lit("")), SECTION_BREAK, -1), section)
    return bind(sections, lambda s: F.concat(F.sha2(F.array_join(s["digest"], ""), 256), F.lit("/"), F.array_join(s["shown"], ";")))


def _node(children: Column, mark: str, shown: Column) -> Column:
    """A node's digest, and how the fingerprint shows the node."""
    digest = F.sha2(children, 256)
    return bind(digest, lambda d: F.struct(d.alias("digest"), F.concat(F.substring(d, 1, DIGITS), F.lit(mark), shown).alias("shown")))


def root(print_: Column) -> Column:
    return F.substring_index(print_, "/", 1)


def paragraph_digests(print_: Column) -> Column:
    """The digests of a fingerprint's paragraphs, in order."""
    return F.regexp_extract_all(print_, F.lit(f"([0-9a-f]{{{DIGITS}}})="), F.lit(1))


def piece_digests(print_: Column) -> Column:
    """The distinct digests of a fingerprint's pieces."""
    lists = F.array_join(F.regexp_extract_all(print_, F.lit("=([0-9a-f]*)"), F.lit(1)), "")
    return F.array_distinct(F.regexp_extract_all(lists, F.lit(f"[0-9a-f]{{{PIECE_DIGITS}}}"), F.lit(0)))


def changed_paragraphs(old: Column, new: Column) -> Column:
    """Numbers (from 0) of the new text's paragraphs that the old text has not; none if the roots are equal."""
    was = paragraph_digests(old)
    numbered = F.transform(paragraph_digests(new), lambda d, i: F.when(~F.array_contains(was, d), i))
    return F.when(root(old) == root(new), F.array().cast("array<int>")).otherwise(F.filter(numbered, lambda i: i.isNotNull()))


def likeness(left: Column, right: Column) -> Column:
    """Dice coefficient of two lists made by ``piece_digests``."""
    return 2.0 * F.size(F.array_intersect(left, right)) / (F.size(left) + F.size(right))


def _cuts_from(key: Column, cuts: list[int]) -> Column:
    """How many of the sorted ``cuts`` are ``key`` or more, by two short searches."""
    if not cuts:
        return F.lit(0)
    each = math.isqrt(len(cuts)) + 1
    groups = [cuts[i : i + each] for i in range(0, len(cuts), each)]

    def longs(values: list[int]) -> str:
        return f"array({', '.join(f'{v}L' for v in values)})"

    largest = F.expr(longs([g[-1] for g in groups]))
    fine = F.expr(f"array({', '.join(longs(g) for g in groups)})")
    after = F.expr(longs([len(cuts) - min(len(cuts), (i + 1) * each) for i in range(len(groups))]))
    group = F.size(F.filter(largest, lambda m: m < key))
    inside = F.size(F.filter(F.get(fine, group), lambda c: c >= key)) + F.get(after, group)
    return F.when(group == len(groups), 0).otherwise(inside).cast("int")


def with_next(docs: DataFrame, value: str, key: str = "doc_id", ranges_per_partition: int = RANGES_PER_PARTITION) -> DataFrame:
    """Adds ``next``: ``value`` of the next row by descending ``key`` (null last; after the last row the first).

    ``docs`` has the columns ``key`` (long) and ``value``. Equal keys go by the hash of their values.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions")) * ranges_per_partition
    bounds = docs.select(F.percentile_approx(key, F.array(*[F.lit(i / n) for i in range(1, n)]), F.lit(20 * n))).first()[0] or []
    cuts = sorted(set(bounds))
    within = _cuts_from(F.col(key), cuts)  # number 0 holds the largest keys; null keys have the last number
    marked = docs.withColumn("part", F.when(F.col(key).isNull(), len(cuts) + 1).otherwise(within)).withColumn("copied", F.lit(False))
    heads = marked.groupBy("part").agg(F.max(key).alias("head_key"))
    before = Window.orderBy("part")
    count = F.count(F.lit(1)).over(Window.partitionBy())
    place = F.row_number().over(before)
    # The part before takes a copy of this part's first row; the last part takes the very first row's.
    heads = heads.select("part", "head_key", F.when(place > 1, F.lag("part").over(before)).otherwise(F.max("part").over(Window.partitionBy())).alias("to_part"), (place == 1).alias("wraps"), count.alias("parts"))
    head_rows = marked.join(F.broadcast(heads), "part").filter(F.col(key).eqNullSafe(F.col("head_key")))
    first_hash = F.row_number().over(Window.partitionBy("part").orderBy(F.xxhash64(value), value))
    head_rows = head_rows.withColumn("turn", first_hash).filter("turn = 1").select(F.col("to_part").alias("part"), key, value, F.lit(True).alias("copied"), "wraps")
    rows = marked.withColumn("wraps", F.lit(False)).select("part", key, value, "copied", "wraps").unionByName(head_rows)
    # Copies come after a part's own rows, the wrapped one last of all.
    order = Window.partitionBy("part").orderBy("copied", "wraps", F.col(key).desc_nulls_last(), F.xxhash64(value), value)
    return rows.withColumn("next", F.lead(value).over(order)).filter("NOT copied").drop("part", "copied", "wraps")


def edited_pairs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Per document: doc_id, text (null as empty), next (the next text), edited.

    ``edited`` replaces the last floor(n / 2) code points by the first as many (or all) of ``next``.
    """
    own = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half), F.substring(F.col("next"), F.lit(1), half))
    return with_next(own, "text").withColumn("edited", edited)
