"""Exact top scores and vector codes against plain loops."""

import hashlib
import math
import random

import numpy as np

from driftwell.llm import top_scores, vector_codes


def odd_rows():
    draw = random.Random(4)
    rows = [(i, [draw.gauss(0, 1) for _ in range(32)], draw.choice([1, 2, None]), "x") for i in range(150)]
    rows += [(i, [round(draw.gauss(0, 1)) / 4 for _ in range(32)], 3, "x") for i in range(150, 300)]  # ties
    rows += [(400 + i, rows[7][1], 1, "y") for i in range(30)]  # copies
    rows += [(20, rows[3][1], 9, "z"), (20, rows[3][1], 9, "z"), (None, rows[5][1], None, None)]
    rows += [(500, None, 1, "x"), (501, [1.0, None], 1, "x"), (502, [float("nan")] * 32, 1, "x"), (503, [float("inf")] + [0.0] * 31, 1, "x")]
    return rows + [(520, [0.5] * 7, 4, "x"), (540, [], 4, "x"), (560, [0.0] * 32, 5, "x"), (580, [1e30] + [0.1] * 31, 5, "x")]


SCHEMA = "vec_id long, embedding array<float>, label int, block string"


def kept(rows, factor):
    out = []
    for id_, vector, label, _ in rows:
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            out.append((id_, [min(max(math.floor(factor * float(np.float32(x))), -(2**22)), 2**22) for x in vector], label))
    return out


def test_top_scores_equal_a_loop(spark):
    rows = kept(odd_rows(), 64)
    wanted = []
    for i, (id_, q, _) in enumerate(rows):
        if id_ is not None and id_ % 20 == 0:
            scored = [(-sum(a * b for a, b in zip(q, v, strict=False)), o is None, o or 0) for j, (o, v, _) in enumerate(rows) if j != i]
            wanted += [(id_, at + 1, None if none else o, -s) for at, (s, none, o) in enumerate(sorted(scored)[:20])]
    frame = spark.createDataFrame(odd_rows(), SCHEMA).repartition(5)
    got = top_scores.top_scores(frame, "vec_id % 20 = 0", 20)
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, wanted))
    few = top_scores.top_scores(frame.filter("vec_id IN (0, 1, 2)"), "vec_id % 20 = 0", 20).collect()
    assert sorted((r.query_id, r["rank"]) for r in few) == [(0, 1), (0, 2)]
    assert top_scores.top_scores(frame.limit(0), "vec_id % 20 = 0", 20).count() == 0


def test_processing_stops_only_on_proof():
    draw = np.random.default_rng(2)
    centres = draw.normal(0, 10, (40, 48))
    vectors = np.floor(centres[draw.integers(0, 40, 6000)] + draw.normal(0, 3, (6000, 48))).astype(np.int32)
    queries, best, shares = np.arange(0, 6000, 60), top_scores.Best(100, 10), []
    for a in range(0, 6000, 1000):
        lists, ends, _ = top_scores.postings(vectors[a : a + 1000])
        block = {"weights": vectors[a : a + 1000], "postings": lists, "ends": ends, "id": np.arange(a, a + 1000), "nameless": np.zeros(1000, int), "row": np.arange(a, a + 1000)}
        shares.append(top_scores.meet(vectors[queries].astype(np.int64), queries, block, best))
    assert min(shares) < 0.9  # part of the postings is never touched
    scores = vectors[queries].astype(np.int64) @ vectors.T.astype(np.int64)
    for n, q in enumerate(queries):
        order = sorted((-s, i) for i, s in enumerate(scores[n].tolist()) if i != q)[:10]
        mine = sorted((-s, i) for o, s, i in zip(best.query, best.score, best.id, strict=True) if o == n)
        assert mine == order


def loop_codes(rows):
    """Books and codes of vectors of one length by comparing every part with every entry."""
    dims = -(-len(rows[0][1]) // 16) * 16
    width = dims // 16
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    parts = np.array([v + [0] * (dims - len(v)) for _, v, _ in rows], dtype=np.int64).reshape(len(rows), 16, width)
    books = parts[:64].transpose(1, 0, 2).copy()

    def nearest():
        return [((parts[:, p, None] - books[p]) ** 2).sum(axis=2) for p in range(16)]

    for _ in range(2):
        for p, distance in enumerate(nearest()):
            entry = distance.argmin(axis=1)
            for e in set(entry.tolist()):
                books[p, e] = parts[entry == e, p].sum(axis=0) // (entry == e).sum()
    last = nearest()
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    return [(id_, "".join(f"{d[i].argmin():02x}" for d in last), int(sum(d[i].min() for d in last)), label, digest) for i, (id_, _, label) in enumerate(rows)]


def test_codes_equal_a_loop(spark):
    rows = kept(odd_rows(), 256)
    coded = [r for length in {len(v) for _, v, _ in rows} for r in loop_codes([x for x in rows if len(x[1]) == length])]
    by_label = {}
    for _, _, error, label, _ in coded:
        by_label[label] = by_label.get(label, 0) + error
    frame = spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)
    got = vector_codes.compress(frame)
    assert got.columns == ["id", "label", "code", "error", "codebooks_sha256", "label_error"]
    found = [(r.id, r.code, r.error, r.label, r.codebooks_sha256, r.label_error) for r in got.collect()]
    assert sorted(map(str, found)) == sorted(str((*c, by_label[c[3]])) for c in coded)
    assert vector_codes.compress(frame.limit(0)).count() == 0


def test_blocks_of_a_large_chunk():
    draw = np.random.default_rng(6)
    numbers = np.concatenate((draw.normal(0, 30, (3000, 32)), draw.normal(200, 2, (1500, 32)))).astype(np.int32)
    row = {"id": [0] * len(numbers), "dims": 32} | vector_codes.pack(numbers, 16)
    chunk, book = vector_codes._Chunk(row, 16), numbers[::70, 4:6].astype(np.int64)
    distance = ((numbers[:, None, 4:6].astype(np.int64) - book) ** 2).sum(axis=2)
    entry, error = chunk.codes(2, book)
    assert (entry == distance.argmin(axis=1)).all() and (error == distance.min(axis=1)).all()
    sums, counts = chunk.totals(2, book)
    for e in range(len(book)):
        mine = distance.argmin(axis=1) == e
        assert counts[e] == mine.sum() and (sums[e] == numbers[mine, 4:6].sum(axis=0)).all()
    listed = vector_codes.shortlists(chunk.low[2], chunk.high[2], book)
    assert listed.mean() < 0.5 and (listed.sum(axis=1) >= 1).all()


def test_hilbert_curve_takes_single_steps():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    walk = grid[np.argsort(vector_codes.hilbert_keys(grid))]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()
