"""Connected components of a link table by alternating large and small stars.

Each round every node hangs its larger neighbours (large star) or its smaller ones (small star) onto the
smallest of them; after a few rounds each component is one star around its smallest node. Nothing but
minima and joins on node ids: no group is gathered, and a round's table is written to the shared folder.

Links point from the larger node to the smaller one. A node's smallest neighbour is the minimum over its own links
(combined before the shuffle), so a root, however many nodes point to it, has no group; the joins that hand the
minimum out are left joins from the links, of which adaptive execution splits a hot side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwell.session import materialize


def _digest(edges: DataFrame):
    """Equal for equal sets of edges; a decimal sum, so that it can't overflow."""
    sums = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return edges.agg(F.count(F.lit(1)), sums).first()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links(a, b)``; the component is its smallest node."""
    edges = materialize(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = _digest(edges)
    while before[0]:
        smallest = edges.groupBy(F.col("a").alias("b")).agg(F.min("b").alias("m"))
        larger = materialize(edges.join(smallest, "b", "left").select("a", F.coalesce("m", "b").alias("b")), "large-star")
        smallest = larger.groupBy("a").agg(F.min("b").alias("m"))
        smaller = larger.join(smallest, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialize(smaller.union(smallest.select("a", F.col("m").alias("b"))).distinct(), "small-star")
        after = _digest(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def merged(joined: DataFrame, links: DataFrame) -> DataFrame:
    """``joined(node, component)`` after further ``links(a, b)`` between components, which alone are gone through.

    A component that was a single node need not be in ``joined``.
    """
    known = materialize(joined, "joined")
    contracted = materialize(components(links), "contracted")
    moved = contracted.select(F.col("node").alias("component"), F.col("component").alias("into"))
    followed = known.join(moved, "component", "left").select("node", F.coalesce("into", "component").alias("component"))
    single = contracted.join(known.select("node"), "node", "left_anti").select("node", "component")
    return materialize(followed.union(single), "components")
