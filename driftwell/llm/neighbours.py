"""Approximate nearest neighbours by cosine: NN-descent graph and greedy graph search, as Spark joins.

1. Equal vectors are one *node*; a node keeps the ids of its smallest ``k + 1`` members, which is all that a
   result of ``k`` can need. Nodes carry their unit vector in half precision through the joins.
2. A first graph: each of a number of sets of random hyperplanes cuts the nodes into leaves of about ``LEAF``
   nodes. Larger leaves (a crowd of like vectors) are cut again at the medians of a sample of the leaf, as
   often as that makes them smaller; only what no plane parts (units equal in half precision) is dealt out by
   chance, so no group is larger than about twice ``LEAF``. Every node takes the best ``DEGREE`` of all its leaves.
3. NN-descent: neighbours, forward and backward, of every node meet at that node and are compared with each
   other; a pair is sent on only where it beats the node's present last neighbour. Backward lists keep the
   ``DEGREE`` best (the graph is an index, its recall is measured). Rounds go on until less than ``SETTLED`` of
   all neighbours are new; centers whose adjacency is as in the round before have nothing to add and sit out.
4. Search: each query node starts from its own neighbours; step by step the unvisited of its best nodes (the
   beam) are joined with the adjacency, their neighbours with the unit vectors, and the best kept, until nothing
   new comes up. No node is visited twice for a query, so this ends.

Each doubling of the nodes above ``LEAF`` adds ``MORE_TREES`` sets of hyperplanes to ``TREES`` and ``MORE_BEAM`` nodes
to a beam of ``BEAM``.
5. The beam's members are scored again with the original vectors in double precision and ranked.

Both sides of every join here grow with the input. A table goes through the driver, as a broadcast, only where its rows
counted and their width in memory come to less than ``SMALL``; all other joins are sort-merge joins. Spark's own choice is
not used: it sizes a table by its Parquet files, far smaller than rows in memory, the more so once a list is exploded.

Vectors that are null, zero, or hold null or non-finite components, and rows with a null id, take no part.
Cosines are between vectors of one length, so each length that a query has is a table of its own. Rows equal in id and
vector are one row. Rows of one id with different vectors are queries and candidates each, also for each other; every
such query has ranks of its own. Ties go to the smaller id. With fewer candidates than ``k`` all are returned; an
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftwell.session import materialize, scratch

TREES = 24
LEAF = 1024
DEGREE = 16
PER_TREE = 12  # neighbours a leaf proposes to a node
MORE_TREES = 2
SAMPLE = 256  # nodes of a crowded leaf that place its cuts
SETTLED = 0.002
PROPOSED = 5  # better neighbours a meeting proposes to a node
BEAM = 96
MORE_BEAM = 16
SMALL = 8 << 20  # bytes of rows in memory; tables below are broadcast
CHUNK = 512  # rows of lists worked on at once in a task
SEED = 20240101
LISTS = "node long, ids array<long>, scores array<float>"


def _units(column: pa.Array) -> np.ndarray:
    """(n, dimensions) float32 of a binary column of half-precision vectors."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype=np.float16).reshape(len(values), -1).astype(np.float32) if values else np.empty((0, 1), np.float32)


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)])
    flat = np.concatenate(rows) if rows else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat, kind))


def _batch(nodes, ids: list[np.ndarray], scores: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), _lists(ids, pa.int64()), _lists(scores, pa.float32())], names=["node", "ids", "scores"])


def _join(left: DataFrame, right: DataFrame, on, how: str = "inner", rows: float = math.inf, width: int = 0) -> DataFrame:
    """A join; ``right`` has ``rows`` rows at most, of ``width`` bytes besides keys and bookkeeping."""
    return left.join(F.broadcast(right) if rows * (width + 64) < SMALL else right.hint("merge"), on, how)


def valid_vectors(df: DataFrame, vector: str, vec_id: str) -> DataFrame:
    """(vec_id, embedding array<double>), distinct rows, of the vectors that take part."""
    values = F.col(f"`{vector}`").cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(values, lambda x: x != 0)
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), values.alias("embedding")).filter(F.col("vec_id").isNotNull() & finite)
    return rows.distinct()


def _nodes(rows: DataFrame, k: int = 5) -> DataFrame:
    """(node, members, embedding, unit): one row per distinct vector; the node is its smallest id.

    Where other vectors have that id too, the node is a number below all ids.
    """
    place = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    few = rows.withColumn("place", place).filter(F.col("place") <= k + 1)
    grouped = few.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("members"))

    @F.arrow_udf("binary")
    def unit(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows_ = [np.asarray(v, dtype=np.float64) for v in batch.to_pylist()]
            # Scaling by the largest component first keeps squares in range.
            scaled = [v / np.abs(v).max() for v in rows_]
            yield pa.array([(v / np.sqrt((v * v).sum())).astype(np.float16).tobytes() for v in scaled], pa.binary())

    repeated = rows.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("vec_id").alias("repeated"))
    repeated = materialize(repeated, "repeated")
    some = repeated.count()
    if not some:  # nearly always
        return grouped.select(F.col("members")[0].alias("node"), "members", "embedding", unit("embedding").alias("unit"))
    named = _join(grouped, repeated, F.col("members")[0] == F.col("repeated"), "left", some)
    least = rows.agg(F.min("vec_id")).first()[0] or 0
    node = F.when(F.col("repeated").isNull(), F.col("members")[0]).otherwise(F.lit(least) - 1 - F.monotonically_increasing_id())
    return named.select(node.alias("node"), "members", "embedding", unit("embedding").alias("unit"))


def _best(ids: list[list[np.ndarray]], scores: list[list[np.ndarray]], own: np.ndarray, keep: int) -> tuple[list, list]:
    """Per row the best ``keep`` distinct ids of several lists, without the row's own."""
    out_ids, out_scores = [], []
    for some, marks, me in zip(ids, scores, own, strict=True):
        i, s = np.concatenate(some), np.concatenate(marks)
        order = np.lexsort((i, -s))
        i, s = i[order], s[order]
        _, first = np.unique(i, return_index=True)
        first.sort()
        first = first[i[first] != me][:keep]
        out_ids.append(i[first])
        out_scores.append(s[first])
    return out_ids, out_scores


def _merged(lists: DataFrame, keep: int = DEGREE) -> DataFrame:
    """Each node's best ``keep`` of all lists it has."""
    gathered = lists.groupBy("node").agg(F.collect_list("ids").alias("ids"), F.collect_list("scores").alias("scores"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), CHUNK):
                part = batch.slice(at, CHUNK)
                nodes = part.column(0).to_numpy()
                ids = [[np.array(x, np.int64) for x in row] for row in part.column(1).to_pylist()]
                scores = [[np.array(x, np.float32) for x in row] for row in part.column(2).to_pylist()]
                yield _batch(nodes, *_best(ids, scores, nodes, keep))

    return gathered.mapInArrow(merge, LISTS)


def _doublings(count: int, leaf: int = LEAF) -> int:
    """Cuts in two that bring ``count`` nodes down to leaves of ``leaf``."""
    return max(0, math.ceil(math.log2(max(count, 1) / leaf)))


def _cut_crowded(placed: DataFrame, units: DataFrame, count: int, dimensions: int, leaf: int) -> DataFrame:
    """Cuts leaves of more than 1.5 ``leaf`` nodes at their medians until that makes no leaf smaller.

    Returns (node, tree, leaf, part): what is left crowded is dealt out by chance to parts.
    """
    before, turn = math.inf, 0
    while True:
        sizes = placed.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n"))
        crowded = sizes.filter(F.col("n") > 1.5 * leaf).withColumn("cuts", F.ceil(F.log2(F.col("n") / leaf)).cast("int"))
        crowded = materialize(crowded, "crowded")
        # The sum of squares falls with every leaf that is parted.
        weight, most, leaves = crowded.agg(F.sum(F.col("n").cast("double") * F.col("n")), F.max("cuts"), F.count(F.lit(1))).first()
        if weight is None:
            return placed.withColumn("part", F.lit(0).cast("long"))
        if weight > 0.99 * before:
            parts = crowded.select("tree", "leaf", F.ceil(F.col("n") / (1.5 * leaf)).alias("parts"))
            part = F.pmod(F.xxhash64("node", "tree"), F.coalesce("parts", F.lit(1)))
            return _join(placed, parts, ["tree", "leaf"], "left", leaves).select("node", "tree", "leaf", part.alias("part"))
        before, turn = weight, turn + 1
        planes = np.random.default_rng(SEED + turn).normal(size=(dimensions, most)).astype(np.float32)
        inside = materialize(_join(placed, crowded, ["tree", "leaf"], rows=leaves).select("node", "tree", "leaf", "n", "cuts"), "inside")
        sample = _join(inside.filter(F.pmod(F.xxhash64("node", "tree", F.lit(turn)), F.col("n")) < SAMPLE), units.select("node", "unit"), "node", rows=count, width=2 * dimensions)

        def middle(table: pa.Table) -> pa.Table:
            middles = np.median(_units(table.column("unit").combine_chunks()) @ planes, axis=0)
            return pa.table({"tree": table.column("tree")[:1], "leaf": table.column("leaf")[:1], "middles": _lists([middles], pa.float32())})

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if len(batch):
                    middles = np.array(batch.column(5).to_pylist(), np.float32)
                    used = np.arange(planes.shape[1]) < batch.column(3).to_numpy()[:, None]
                    sides = (_units(batch.column(4)) @ planes > middles) & used
                    codes = (sides * (np.int64(1) << np.arange(planes.shape[1], dtype=np.int64))).sum(axis=1, dtype=np.int64)
                    yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(codes)], names=["node", "tree", "leaf", "code"])

        middles = sample.select("tree", "leaf", "unit").groupBy("tree", "leaf").applyInArrow(middle, "tree int, leaf long, middles array<float>")
        named = _join(inside, middles, ["tree", "leaf"], rows=leaves, width=4 * most)
        rows = _join(named, units.select("node", "unit"), "node", rows=count, width=2 * dimensions).select("node", "tree", "leaf", "cuts", "unit", "middles")
        parted = rows.mapInArrow(cut, "node long, tree int, leaf long, code long")
        smaller = parted.select("node", "tree", F.xxhash64("leaf", F.lit(turn), "code").alias("leaf"))
        kept = _join(placed, crowded, ["tree", "leaf"], "left_anti", leaves).select("node", "tree", "leaf")
        placed = materialize(kept.union(smaller), "leaves")


def _forest(units: DataFrame, count: int, dimensions: int, trees: int, leaf: int) -> DataFrame:
    """Lists of near nodes found within the leaves."""
    bits = _doublings(count, leaf)
    trees = trees if bits else 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.random.default_rng(SEED).normal(size=(dimensions, trees * bits)).astype(np.float32)
        for batch in batches:
            nodes = batch.column(0).to_numpy()
            sides = (_units(batch.column(1)) @ planes > 0).reshape(len(nodes), trees, bits)
            codes = (sides * (np.int64(1) << np.arange(bits, dtype=np.int64))).sum(axis=2, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(nodes, trees)), pa.array(np.tile(np.arange(trees), len(nodes)), pa.int32()), pa.array(codes.reshape(-1))], names=["node", "tree", "leaf"])

    placed = materialize(units.select("node", "unit").mapInArrow(cut, "node long, tree int, leaf long"), "leaves")
    dealt = _cut_crowded(placed, units, count, dimensions, leaf)

    def compare(table: pa.Table) -> pa.Table:
        nodes = table.column("node").to_numpy()
        unit = _units(table.column("unit").combine_chunks())
        ids, scores = [], []
        n = min(PER_TREE, len(nodes) - 1)
        for at in range(0, len(nodes), CHUNK):
            near = unit[at : at + CHUNK] @ unit.T
            rows = np.arange(len(near))
            near[rows, rows + at] = -3
            best = np.argpartition(-near, max(n - 1, 0), axis=1)[:, :n]
            ids += list(nodes[best])
            scores += list(np.take_along_axis(near, best, 1))
        return pa.Table.from_batches([_batch(nodes, ids, scores)])

    return _join(dealt, units.select("node", "unit"), "node", rows=count, width=2 * dimensions).groupBy("tree", "leaf", "part").applyInArrow(compare, LISTS)


def _adjacency(graph: DataFrame) -> DataFrame:
    """(center, member) links: each node's neighbours, and the nodes that have it as one (the best of them)."""
    links = graph.select("node", F.inline(F.arrays_zip("ids", "scores"))).toDF("center", "member", "score")
    place = F.row_number().over(Window.partitionBy("member").orderBy(F.desc("score"), "center"))
    back = links.withColumn("place", place).filter(F.col("place") <= DEGREE).select(F.col("member").alias("center"), F.col("center").alias("member"))
    both = links.select("center", "member").union(back)
    return both.groupBy("center").agg(F.array_sort(F.collect_set("member")).alias("near"))


def _descend(graph: DataFrame, adjacency: DataFrame, units: DataFrame, count: int, dimensions: int) -> DataFrame:
    """One round: members of each center's adjacency (center, near) are compared with each other."""
    # What a node's next neighbour has to beat; nodes with few neighbours take any.
    last = F.when(F.size("scores") < DEGREE, -2.0).otherwise(F.array_min("scores")).cast("float")
    known = _join(units.select("node", "unit"), graph.select("node", last.alias("last")), "node", rows=count)
    met = _join(adjacency.select("center", F.explode("near").alias("member")), known.withColumnRenamed("node", "member"), "member", rows=count, width=2 * dimensions)
    meetings = met.groupBy("center").agg(F.collect_list(F.struct("member", "unit", "last")).alias("members"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, ids, scores = [], [], []
            column = batch.column(0)
            flat = column.flatten()
            member, unit, least = flat.field("member").to_numpy(), _units(flat.field("unit")), flat.field("last").to_numpy()
            ends = np.cumsum(column.value_lengths().to_numpy())
            for first, end in zip(np.concatenate(([0], ends)), ends, strict=False):
                own, u = member[first:end], unit[first:end]
                near = u @ u.T
                np.fill_diagonal(near, -3)
                n = min(PROPOSED, len(own) - 1)
                if n < 1:
                    continue
                best = np.argpartition(-near, n - 1, axis=1)[:, :n]
                marks = np.take_along_axis(near, best, 1)
                better = marks > least[first:end, None]
                for row in np.flatnonzero(better.any(axis=1)):
                    nodes.append(own[row])
                    ids.append(own[best[row][better[row]]])
                    scores.append(marks[row][better[row]])
            yield _batch(nodes, ids, scores)

    return _merged(graph.union(meetings.select("members").mapInArrow(compare, LISTS)))


def neighbour_graph(nodes: DataFrame, trees: int | None = None, leaf: int = LEAF, descents: int | None = None) -> DataFrame:
    """(node, ids, scores): each node's neighbours, best first, of nodes (node, unit); ``descents`` ends the rounds early."""
    units = nodes.select("node", "unit")
    head = units.first()
    if head is None:
        return nodes.sparkSession.createDataFrame([], LISTS)
    dimensions, count = len(head["unit"]) // 2, units.count()
    trees = TREES + MORE_TREES * _doublings(count, leaf) if trees is None else trees
    graph = materialize(_merged(_forest(units, count, dimensions, trees, leaf)), "graph")
    before, rounds = None, 0
    while rounds != descents:
        adjacency = materialize(_adjacency(graph), "adjacency")
        moved = adjacency
        if before is not None:
            moved = _join(adjacency, before.withColumnRenamed("near", "was"), "center", "left", count, 16 * DEGREE).filter(~F.col("near").eqNullSafe(F.col("was"))).select("center", "near")
        old, graph = graph, materialize(_descend(graph, moved, units, count, dimensions), "graph")
        before, rounds = adjacency, rounds + 1
        both = _join(graph, old.select("node", F.col("ids").alias("was")), "node", rows=count, width=8 * DEGREE)
        new, total = both.agg(F.sum(F.size(F.array_except("ids", "was"))), F.sum(F.size("ids"))).first()
        if new <= SETTLED * total:
            break
    return graph


def _search(graph: DataFrame, units: DataFrame, queries: DataFrame, beam: int, count: float = math.inf, dimensions: int = 0) -> DataFrame:
    """(query, ids): the best ``beam`` nodes that greedy search finds for each query node, itself among them; there are ``count`` nodes."""
    adjacency = materialize(_adjacency(graph), "adjacency")
    start = _join(queries.select(F.col("node").alias("query"), "unit"), graph.withColumnRenamed("node", "query"), "query", rows=count, width=12 * DEGREE)
    state = start.select("query", "unit", "ids", "scores", F.array().cast("array<long>").alias("done"))

    def advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            queries_, ids, scores, done = batch.column(0).to_numpy(), [], [], []
            unit = _units(batch.column(1))
            old_ids, old_scores, visited, found = (batch.column(i) for i in range(2, 6))
            for row in range(len(batch)):
                was, mark = np.array(old_ids[row].as_py(), np.int64), np.array(old_scores[row].as_py(), np.float32)
                seen = np.array(visited[row].as_py(), np.int64)
                # All that was in the beam before this step is visited now.
                seen = np.union1d(seen, was)
                fresh = found[row].values if found[row].is_valid else None
                if fresh is not None and len(fresh):
                    near = _units(fresh.field("unit")) @ unit[row]
                    (best,), (marks,) = _best([[was, fresh.field("node").to_numpy()]], [[mark, near]], np.array([queries_[row]]), beam)
                else:
                    best, marks = was, mark
                ids.append(best)
                scores.append(marks)
                done.append(seen)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _lists(ids, pa.int64()), _lists(scores, pa.float32()), _lists(done, pa.int64())], names=["query", "unit", "ids", "scores", "done"])

    schema = "query long, unit binary, ids array<long>, scores array<float>, done array<long>"
    ended = []
    while True:
        state = materialize(state, "search")
        open_ = F.size(F.array_except("ids", "done")) > 0
        ended.append(state.filter(~open_).select("query", "ids"))
        state = state.filter(open_)
        if state.isEmpty():
            break
        # Pairs only: a query's lists in each of its rows would be its beam squared.
        frontier = state.select("query", F.explode(F.array_except("ids", "done")).alias("center"))
        reached = _join(frontier, adjacency, "center", rows=count, width=16 * DEGREE).select("query", F.explode("near").alias("node"), F.lit(False).alias("had"))
        had = state.select("query", F.explode("ids").alias("node"), F.lit(True).alias("had"))
        new = reached.union(had).repartition("query").groupBy("query", "node").agg(F.max("had").alias("had")).filter("NOT had").select("query", "node")
        scored = _join(new, units, "node", rows=count, width=2 * dimensions).groupBy("query").agg(F.collect_list(F.struct("node", "unit")).alias("found"))
        state = _join(state, scored, "query", "left").mapInArrow(advance, schema)
    return reduce(DataFrame.union, ended).select("query", F.array_union("ids", F.array("query")).alias("ids"))


def nearest(
    df: DataFrame, queries: str, vector: str = "embedding", vec_id: str = "vec_id", k: int = 5, beam: int | None = None
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for the rows that meet ``queries``, a SQL condition on vec_id."""
    empty = df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    with scratch(df.sparkSession) as keep:
        rows = materialize(valid_vectors(df, vector, vec_id).withColumn("length", F.size("embedding")), "vectors")
        lengths = sorted(r.length for r in rows.filter(queries).select("length").distinct().collect())
        parts = [_nearest(rows.filter(F.col("length") == n).drop("length"), n, queries, k, beam) for n in lengths]
        return keep(reduce(DataFrame.union, parts, empty), "neighbours")


def _nearest(rows: DataFrame, dimensions: int, queries: str, k: int, beam: int | None) -> DataFrame:
    """``nearest`` for distinct rows (vec_id, embedding) of one length."""
    nodes = materialize(_nodes(rows, k), "nodes")
    units = nodes.select("node", "unit")
    graph, count = neighbour_graph(nodes), nodes.count()
    beam = max(BEAM + MORE_BEAM * _doublings(count), 2 * k) if beam is None else beam
    asked = rows.filter(queries).select(F.col("vec_id").alias("query_id"), "embedding")
    asked = materialize(_join(asked, nodes.select("embedding", F.col("node").alias("query")), "embedding", rows=count, width=8 * dimensions), "queries")
    starts = _join(asked.select(F.col("query").alias("node")).distinct(), units, "node", rows=count, width=2 * dimensions)
    found = _search(graph, units, starts, beam, count, dimensions)
    pairs = found.select("query", F.explode("ids").alias("node"))

    @F.arrow_udf("double")
    def cosine(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in batches:
            out = [np.empty(0)]
            for at in range(0, len(left), CHUNK):
                a, b = (np.array(side.slice(at, CHUNK).to_pylist(), dtype=np.float64) for side in (left, right))
                a, b = (x / np.abs(x).max(axis=1, keepdims=True) for x in (a, b))
                out.append((a * b).sum(axis=1) / np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1)))
            yield pa.array(np.concatenate(out))

    met = _join(pairs, nodes.select("node", "members", F.col("embedding").alias("right")), "node", rows=count, width=8 * (dimensions + k + 1))
    met = _join(met, asked.dropDuplicates(["query"]).select("query", F.col("embedding").alias("left")), "query", rows=count, width=8 * dimensions)
    scored = met.select("query", "node", "members", cosine("left", "right").alias("score"))
    listed = scored.select("query", "node", "score", F.explode("members").alias("vec_id"))
    # A query's own row is at most one of these, so k + 1 of its node are enough for any of them.
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "node"))
    best = listed.withColumn("place", place).filter(F.col("place") <= k + 1).drop("place")
    own = _join(asked.select("query_id", "query"), best, "query", rows=count * (k + 1)).filter("vec_id <> query_id OR node <> query")
    rank = F.row_number().over(Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id", "node"))
    return own.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
