"""Recall and exact scores against brute force; odd vectors."""

import numpy as np

from driftwell.llm import neighbours, queries
from driftwell.session import materialize


def test_recall(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in rows])
    vectors = np.array([r.embedding for r in rows], dtype=np.float64)
    norms = np.linalg.norm(vectors, axis=1)
    got = {}
    for r in queries.op8_neighbours(spark, sf_dir).collect():
        got.setdefault(r.query_id, []).append(r)
    hits = 0
    asked = np.flatnonzero(ids % 50 == 0)
    for i in asked:
        scores = vectors @ vectors[i] / (norms * norms[i])
        scores[i] = -9
        mine = sorted(got[ids[i]], key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5]
        assert all(abs(r.score - scores[np.flatnonzero(ids == r.vec_id)[0]]) < 1e-12 for r in mine)
        hits += len({r.vec_id for r in mine} & set(ids[np.lexsort((ids, -scores))[:5]]))
    assert hits >= 0.9 * 5 * len(asked)


def test_graph_search_with_several_leaves(spark):
    draw = np.random.default_rng(1)
    vectors = draw.normal(size=(1200, 16)).astype(np.float32)
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    nodes = materialize(neighbours._nodes(neighbours.valid_vectors(frame, "embedding", "vec_id")), "nodes")
    graph = {r.node: r.ids for r in neighbours.neighbour_graph(nodes, trees=8, leaf=128, descents=2).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = unit @ unit.T
    np.fill_diagonal(near, -2)
    best = np.argsort(-near, axis=1)[:, :5]
    assert np.mean([len(set(best[i]) & set(graph[i])) / 5 for i in range(1200)]) > 0.9


def test_odd_vectors(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [1.0, None]), (7, [1.0, 1.0, 1.0]), (None, [1.0, 0.0]), (8, [0.0, 1.0]), (8, [0.0, 1.0])]
    frame = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<float>, rank int")
    got = [(r["rank"], r.vec_id, r.score) for r in neighbours.nearest(frame, "vec_id = 0").orderBy("rank").collect()]
    assert got == [(1, 1, 1.0), (2, 2, 1.0), (3, 8, 0.0)]
    assert neighbours.nearest(frame.limit(0), "vec_id = 0").count() == 0


def test_crowd_is_cut_and_not_dealt(spark):
    draw = np.random.default_rng(2)
    spread = np.zeros((600, 16))
    spread[:, :4] = 0.3 * draw.normal(size=(600, 4))
    vectors = np.concatenate([draw.normal(size=16) + spread, draw.normal(size=(600, 16))]).astype(np.float16).astype(np.float64)
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    nodes = materialize(neighbours._nodes(neighbours.valid_vectors(frame, "embedding", "vec_id")), "nodes")
    graph = {r.node: r.ids for r in neighbours.neighbour_graph(nodes, trees=8, leaf=64, descents=0).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = unit @ unit.T
    np.fill_diagonal(near, -2)
    best = np.argsort(-near, axis=1)[:, :5]
    assert np.mean([len(set(best[i]) & set(graph[i])) / 5 for i in range(600)]) > 0.9


def test_search_goes_on_until_nothing_new_comes_up(spark):
    # A chain of 40 nodes; the query is at its far end and starts at the near one.
    angles = [*np.linspace(1.5, 0.05, 40), 0.0]
    units = [(i, bytearray(np.array([np.cos(a), np.sin(a)], np.float16).tobytes())) for i, a in enumerate(angles)]
    links = [(i, [i + 1] if i < 39 else [38], [0.9]) for i in range(40)] + [(40, [0], [0.0])]
    unit = spark.createDataFrame(units, "node long, unit binary")
    graph = spark.createDataFrame(links, neighbours.LISTS)
    found = neighbours._search(graph, unit, unit.filter("node = 40"), 4).first()
    assert {39, 38, 37} <= set(found.ids)


def test_crowds_copies_lengths_and_repeated_ids(spark):
    """The whole search over several leaves, with a crowd, equal vectors, two lengths and ids of two vectors."""
    draw = np.random.default_rng(3)
    crowd = np.repeat(draw.normal(size=(1, 16)), 800, axis=0) + 0.2 * draw.normal(size=(800, 16))
    copies = np.repeat(draw.normal(size=(1, 16)), 20, axis=0)
    wide = np.concatenate([copies, crowd, draw.normal(size=(1680, 16))])
    rows = [(i, v.tolist()) for i, v in enumerate(wide)]
    rows += [(5000 + i, v.tolist()) for i, v in enumerate(draw.normal(size=(30, 4)))]  # a rarer length
    rows += [(100, wide[2400].tolist()), (100, wide[100].tolist()), (2400, draw.normal(size=16).tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    distinct = {(i, tuple(v)) for i, v in rows}
    got = {}
    for r in neighbours.nearest(frame, "vec_id % 50 = 0", k=10).collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score, r["rank"]))
    hits = total = 0
    for i in sorted({i for i, _ in distinct if i % 50 == 0}):
        queries_ = [q for q in distinct if q[0] == i]
        assert sorted(r for _, _, r in got[i]) == sorted(list(range(1, 11)) * len(queries_))
        for q in queries_:
            others = sorted(((-float(np.dot(q[1], o[1]) / np.linalg.norm(q[1]) / np.linalg.norm(o[1])), o[0]) for o in distinct if o != q and len(o[1]) == len(q[1])))[:10]
            mine = {(v, round(s, 9)) for v, s, _ in got[i]}
            hits += sum((v, round(-s, 9)) in mine for s, v in others)
            total += 10
            if i in (0, 5000):  # equal vectors and small tables are found whole
                assert [v for v, _, _ in sorted(got[i], key=lambda r: r[2])] == [v for _, v in others]
    assert hits >= 0.95 * total


def test_no_table_goes_through_the_driver(spark, monkeypatch):
    """With no table small enough, all joins are sort-merge joins, however small Spark takes their files for."""
    frames, plans = type(spark.range(0)), []
    join = frames.join
    monkeypatch.setattr(neighbours, "SMALL", 0, raising=False)

    def seen(self, *args):
        joined = join(self, *args)
        plans.append(joined._jdf.queryExecution().executedPlan().toString())
        return joined

    monkeypatch.setattr(frames, "join", seen)
    draw = np.random.default_rng(4)
    vectors = np.concatenate([draw.normal(size=8) + 0.05 * draw.normal(size=(300, 8)), draw.normal(size=(1300, 8))])
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(50, vectors[0].tolist()), (51, vectors[1].tolist())]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(frame, "vec_id % 50 = 0", k=3).collect()
    assert len(got) == 3 * 33
    nodes = materialize(neighbours._nodes(neighbours.valid_vectors(frame, "embedding", "vec_id")), "nodes")
    before = len(plans)
    assert neighbours.neighbour_graph(nodes, trees=4, leaf=64, descents=2).count() == nodes.count()
    assert before > 10 and len(plans) - before > 10  # crowded leaves are cut, too
    assert [p for p in plans if "Broadcast" in p] == []


def test_search_passes_pairs_and_not_lists(spark, monkeypatch):
    """A query's beam does not travel with each node that it reaches."""
    widest = []
    frames = type(spark.range(0))
    join = frames.join

    def seen(self, *args):
        widest.append([x for x in self.columns if x in ("ids", "scores", "done", "left")] if "center" in self.columns and "query" in self.columns else [])
        return join(self, *args)

    monkeypatch.setattr(frames, "join", seen)
    draw = np.random.default_rng(5)
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(draw.normal(size=(300, 8)))], "vec_id long, embedding array<double>")
    neighbours.nearest(frame, "vec_id % 50 = 0").collect()
    assert [x for x in widest if x] == []
    assert len(widest) > 5


def test_queries_of_equal_vectors_leave_out_only_themselves(spark):
    """Queries that share a node are ranked from its k + 1 best."""
    rows = [(i, [1.0, 0.5]) for i in range(7)] + [(10, [1.0, 0.6]), (11, [0.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(frame, "vec_id < 7 OR vec_id = 10", k=2).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {0: [1, 2], 1: [0, 2], **{i: [0, 1] for i in range(2, 7)}, 10: [0, 1]}


def test_counted_rows_decide_what_is_broadcast(spark):
    frame = spark.range(10).toDF("node")
    few, many = (neighbours._join(frame, frame, "node", rows=n, width=128)._jdf.queryExecution().executedPlan().toString() for n in (10, 1 << 20))
    assert "BroadcastHashJoin" in few and "Broadcast" not in many
