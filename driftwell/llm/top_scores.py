"""Exact top-k by inner product over an impact-ordered index, evaluated score at a time.

Components become whole numbers (see ``vectors``); a vector is a document whose terms are its components and
whose weights are their values. The index cuts the table into blocks. A block has, for every term, its
postings (the vectors with a weight) in segments of equal quantised impact, strongest first.

A batch of queries meets a block like this:

1. The block's segments of all terms are taken by descending impact, the segment's level times the largest
   weight any query of the batch gives the term. A segment adds its exact products to the scores of its
   vectors and takes its weights off what is left of them.
2. The rest of a score can't exceed the product of the query's norm and the norm of what is left of the vector.
   From time to time the vectors that this bound keeps from the query's ``k`` best so far are counted out.
   Processing stops only when so few possible members are left that to score them is cheaper than to go on;
   what is counted out is proven to be out, with ties on the safe side.
3. Possible members are scored exactly from the whole vectors, and the ``k`` best kept. The batch goes on to
   the next block with these, so that later blocks start from a high bar.

Queries and blocks are dealt to (group of queries, slice of the index); each of these holds a bounded number of
queries, meets its slice in one task and hands on ``k`` rows for a query. No task sees all vectors or queries.

Rows whose vector is null or holds null or non-finite components take no part. A shorter vector counts as
filled up with zeros. A query's own row is no candidate, other rows of its id are; repeated query rows are
answered each. Ties go to the smaller id, null ids last. Null ids are candidates but no queries. With fewer than
``k`` candidates all are returned; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftwell.llm.vectors import padded, usable, whole_numbers
from driftwell.session import materialize, scratch

FACTOR = 64
LEVELS = 16  # quantised impacts of a block
BLOCK_NUMBERS = 1 << 18  # components in a block: 4,096 vectors of 64
GROUP_QUERIES = 1024
SLICE_ROWS = 16_384
BATCH = 256  # queries that meet a block together
LOOKS = 12  # times that possible members are counted while a block is processed
NO_BAR = np.int64(-1) << 62  # below any score, and far enough from the end of the range to subtract from
FEW = 1 / 24  # of a block's scores: no more possible members are scored rather than processed on

_INDEX = "block long, width int, row array<long>, id array<long>, asks array<boolean>, weights binary, postings binary, ends binary"


def postings(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Vectors of all terms' segments, the strongest first; where the segments end (terms, LEVELS); a level's step."""
    strength = np.abs(weights.T)
    step = int(strength.max(initial=0)) // LEVELS + 1
    level = -(-strength // step)  # 0 only for a weight of 0
    order = np.argsort(-level, axis=1, kind="stable").astype(np.int32)
    counts = np.stack([(level == at).sum(axis=1) for at in range(LEVELS, 0, -1)], axis=1)
    ends = np.cumsum(counts, axis=1)
    kept = np.concatenate([o[:e] for o, e in zip(order, ends[:, -1], strict=True)]) if len(order) else np.empty(0, np.int32)
    return kept, ends.astype(np.int32), step


def _index(rows: DataFrame, factor: int) -> DataFrame:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held, size = [], 0

        def block() -> pa.RecordBatch:
            nonlocal number, held, size
            width = max(n.max(initial=0) for _, n, _, _ in held)
            weights = np.concatenate([padded(v, n, width) for v, n, _, _ in held])
            lists, ends, _ = postings(weights)
            made = {"block": pa.array([number], pa.int64()), "width": pa.array([width], pa.int32())}
            own = number << 20 | np.arange(len(weights))
            ids, asks = (pa.concat_arrays([h[i] for h in held]) for i in (2, 3))
            for name, values in (("row", pa.array(own, pa.int64())), ("id", ids), ("asks", asks)):
                made[name] = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            for name, numbers in (("weights", weights), ("postings", lists), ("ends", ends)):
                made[name] = pa.array([numbers.tobytes()], pa.binary())
            number, held, size = number + 1, [], 0
            return pa.RecordBatch.from_pydict(made)

        for batch in batches:
            values, lengths = whole_numbers(batch.column("vector"), factor)
            most = max(1, BLOCK_NUMBERS // max(int(lengths.max(initial=1)), 1))
            starts = np.concatenate(([0], np.cumsum(lengths)))
            for a in range(0, len(lengths), most):
                b = min(a + most, len(lengths))
                held.append((values[starts[a] : starts[b]], lengths[a:b], batch.column("id").slice(a, b - a), batch.column("asks").slice(a, b - a)))
                size += b - a
                if size >= most:
                    yield block()
        if held:
            yield block()

    return materialize(rows.mapInArrow(build, _INDEX), "index")


def _queries(index: DataFrame) -> DataFrame:
    """(row, id, width, weights) of the rows that ask."""

    def asking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                weights = np.frombuffer(r["weights"], np.int32).reshape(len(r["row"]), r["width"])
                some = np.flatnonzero(np.array(r["asks"], dtype=bool))
                columns = [pa.array([r["row"][i] for i in some], pa.int64()), pa.array([r["id"][i] for i in some], pa.int64()), pa.array([r["width"]] * len(some), pa.int32()), pa.array([weights[i].tobytes() for i in some], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "id", "width", "weights"])

    return materialize(index.select("row", "id", "asks", "width", "weights").mapInArrow(asking, "row long, id long, width int, weights binary"), "queries")


class Best:
    """The ``k`` best candidates of each query so far."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.query, self.score, self.id, self.nameless, self.row = (np.empty(0, np.int64) for _ in range(5))
        self.bar = np.full(queries, NO_BAR)  # score of the k-th; what scores less is out

    def add(self, query: np.ndarray, score: np.ndarray, id: np.ndarray, nameless: np.ndarray, row: np.ndarray) -> None:
        q, s, i, n, r = (np.concatenate(x) for x in ((self.query, query), (self.score, score), (self.id, id), (self.nameless, nameless), (self.row, row)))
        order = np.lexsort((r, i, n, -s, q))
        place = np.arange(len(order)) - np.searchsorted(q[order], q[order])
        order = order[place < self.k]
        self.query, self.score, self.id, self.nameless, self.row = q[order], s[order], i[order], n[order], r[order]
        last = place[place < self.k] == self.k - 1
        self.bar[self.query[last]] = self.score[last]


def meet(queries: np.ndarray, own: np.ndarray, block: dict, best: Best) -> float:
    """Bring the best of ``queries`` (with row keys ``own``) up to date with one block; the share of postings processed."""
    weights, lists, ends, ids, nameless, rows = (block[c] for c in ("weights", "postings", "ends", "id", "nameless", "row"))
    n, width = weights.shape
    queries = queries[:, :width]
    narrow = int(np.abs(queries).max(initial=0)) * int(np.abs(weights).max(initial=0)) * max(width, 1) < 1 << 31
    kind = np.int32 if narrow else np.int64
    scores = np.zeros((n, len(queries)), dtype=kind)
    terms = np.ascontiguousarray(queries.T.astype(kind))
    strongest = np.abs(terms.astype(np.int64)).max(axis=1, initial=0)
    norms = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
    left = (weights.astype(np.float64) ** 2).sum(axis=1)
    term_starts = np.concatenate(([0], np.cumsum(ends[:, -1]))) if width else np.zeros(1, np.int64)
    begins = np.concatenate((np.zeros((width, 1), np.int32), ends[:, :-1]), axis=1)
    impact = strongest[:, None] * np.arange(LEVELS, 0, -1)
    term, level = np.nonzero((ends > begins) & (impact > 0))
    order = np.argsort(-impact[term, level], kind="stable")
    total = int(ends[:, -1].sum()) if width else 0
    done, look = 0, total / LOOKS
    possible = None
    for t, at in zip(term[order].tolist(), level[order].tolist(), strict=True):
        some = lists[term_starts[t] + begins[t, at] : term_starts[t] + ends[t, at]]
        weight = weights[some, t]
        scores[some] += weight.astype(kind)[:, None] * terms[t]
        left[some] -= weight.astype(np.float64) ** 2
        done += len(some)
        if done >= look:
            look += total / LOOKS
            rest = np.sqrt(np.maximum(left, 0.0))
            bar = best.bar
            if n > best.k and (bar == NO_BAR).any():
                # No bar yet: of what the scores are at least, the one after the k-th, as the query's own row may be among them.
                least = scores - (rest[:, None] * norms + 1.0)
                bar = np.maximum(bar, np.floor(np.partition(least, n - best.k - 1, axis=0)[n - best.k - 1]).astype(np.int64))
            reach = bar - scores
            open_ = reach <= rest[:, None] * norms + 1.0
            if open_.sum() <= FEW * scores.size:
                possible = open_
                break
    if possible is None:
        doc, query = np.nonzero(scores >= best.bar)
        exact = scores[doc, query].astype(np.int64)
    else:
        doc, query = np.nonzero(possible)
        exact = np.empty(len(doc), np.int64)
        for a in range(0, len(doc), 1 << 15):
            pairs = slice(a, a + (1 << 15))
            exact[pairs] = (weights[doc[pairs]].astype(np.int64) * queries[query[pairs]]).sum(axis=1)
    real = (rows[doc] != own[query]) & (exact >= best.bar[query])
    doc, query, exact = doc[real], query[real], exact[real]
    best.add(query, exact, ids[doc], nameless[doc], rows[doc])
    return done / max(total, 1)


def _answered(key: tuple, asked: pa.Table, slice_: pa.Table, k: int) -> pa.Table:
    widths = asked.column("width").to_pylist()
    queries = np.zeros((asked.num_rows, max(widths, default=0)), np.int64)
    for i, (blob, width) in enumerate(zip(asked.column("weights").to_pylist(), widths, strict=True)):
        queries[i, :width] = np.frombuffer(blob, np.int32)
    own, names = np.array(asked.column("row").to_pylist(), np.int64), np.array(asked.column("id").to_pylist(), np.int64)
    batches = [slice(a, a + BATCH) for a in range(0, len(queries), BATCH)]
    bests = [Best(len(queries[b]), k) for b in batches]
    for number in range(slice_.num_rows):
        row = slice_.slice(number, 1).to_pylist()[0]
        width = row["width"]
        ids = row["id"]
        block = {
            "weights": np.frombuffer(row["weights"], np.int32).reshape(len(ids), width),
            "postings": np.frombuffer(row["postings"], np.int32),
            "ends": np.frombuffer(row["ends"], np.int32).reshape(width, LEVELS),
            "id": np.array([i or 0 for i in ids], np.int64),
            "nameless": np.array([i is None for i in ids], np.int64),
            "row": np.array(row["row"], np.int64),
        }
        wide = np.zeros((len(queries), max(width, queries.shape[1])), np.int64)
        wide[:, : queries.shape[1]] = queries
        for some, best in zip(batches, bests, strict=True):
            meet(wide[some], own[some], block, best)
    found = {name: [] for name in ("query_row", "query_id", "id", "row", "score")}
    for some, best in zip(batches, bests, strict=True):
        found["query_row"].append(own[some][best.query])
        found["query_id"].append(names[some][best.query])
        found["id"].append(np.where(best.nameless == 1, None, best.id))
        found["row"].append(best.row)
        found["score"].append(best.score)
    return pa.table({name: pa.array(np.concatenate(values).tolist() if values else [], pa.int64()) for name, values in found.items()})


def top_scores(df: DataFrame, queries: str, k: int, vector: str = "embedding", id: str = "vec_id", factor: int = FACTOR) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` highest inner products of every row for which the SQL condition ``queries`` holds."""
    asks = F.coalesce(F.expr(queries), F.lit(False)) & F.col(f"`{id}`").isNotNull()
    rows = df.filter(usable(vector)).select(F.col(f"`{id}`").cast("long").alias("id"), asks.alias("asks"), F.col(f"`{vector}`").alias("vector"))
    with scratch(df.sparkSession) as keep:
        index = _index(rows, factor)
        asked = _queries(index)
        groups = max(1, -(-asked.count() // GROUP_QUERIES))
        slices = max(1, -(-(index.agg(F.sum(F.size("row"))).first()[0] or 0) // SLICE_ROWS))
        dealt = asked.selectExpr("*", f"pmod(xxhash64(row), {groups}L) AS group").selectExpr("*", f"explode(sequence(0L, {slices - 1}L)) AS slice")
        blocks = index.drop("asks").selectExpr("*", f"pmod(xxhash64(block), {slices}L) AS slice").selectExpr("*", f"explode(sequence(0L, {groups - 1}L)) AS group")

        def answered(key, left: pa.Table, right: pa.Table) -> pa.Table:
            return _answered(key, left, right, k)

        schema = "query_row long, query_id long, id long, row long, score long"
        found = dealt.groupBy("group", "slice").cogroup(blocks.groupBy("group", "slice")).applyInArrow(answered, schema)
        order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        return keep(ranked.select("query_id", "rank", "id", "score"), "top-scores")
