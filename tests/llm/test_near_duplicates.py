"""Signatures against exact similarity, classes against brute force."""

import re
from collections import Counter

import numpy as np
import pytest

from driftwell.llm import bagminhash, components, near_duplicates, shingles


def counted(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", (text or "").lower()) if w]
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def similarity(a, b):
    a, b = counted(a), counted(b)
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 1.0


def brute_classes(texts):
    parent = list(range(len(texts)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if similarity(texts[i], texts[j]) >= 0.8:
                parent[top(i)] = top(j)
    return [top(i) for i in range(len(texts))]


def test_signatures_are_unbiased():
    draw = np.random.default_rng(0)
    elements = draw.integers(1, 2**63, 200).astype(np.uint64)
    a, b = draw.integers(0, 9, 200), draw.integers(0, 9, 200)
    b = np.where(draw.random(200) < 0.7, a, b)
    owner = np.concatenate((np.zeros((a > 0).sum(), int), np.ones((b > 0).sum(), int)))
    found = bagminhash.signatures(owner, np.concatenate((elements[a > 0], elements[b > 0])), np.concatenate((a[a > 0], b[b > 0])), 2, 6000)
    assert abs((found[0] == found[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.02


def sample_texts():
    draw = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(12):
        base = list(draw.choice(words, 120))
        texts.append(" ".join(base))
        for change in (1, 2, 3, 6, 10):
            copy = list(base)
            for at in draw.integers(0, 120, change):
                copy[at] = "changed"
            texts.append(" ".join(copy))
        texts += [" ".join(base), " ".join(base).upper() + " \n"]
    return texts + ["", None, " \n", "one two", "One  two", "x " * 400, "x " * 330]


def test_similarity_equals_counters():
    texts = [t or "" for t in sample_texts()]
    got = shingles.weighted_jaccard(texts[:-1], texts[1:])
    assert np.allclose(got, [similarity(a, b) for a, b in zip(texts, texts[1:], strict=False)])


def test_classes_equal_brute_force(spark):
    texts = sample_texts()
    wanted = brute_classes(texts)
    frame = spark.createDataFrame([(i, t, "x", 0) for i, t in enumerate(texts)], "doc_id long, text string, node string, key int")
    got = {r.doc_id: r.class_id for r in near_duplicates.near_duplicates(frame).collect()}
    least = {}
    for i, c in enumerate(wanted):
        least.setdefault(c, i)
    assert got == {i: least[c] for i, c in enumerate(wanted)}
    kept = near_duplicates.drop_near_duplicates(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(least.values())


def test_null_ids_repeated_rows_and_empty(spark):
    schema = "doc_id long, text string"
    frame = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (1, "a b c"), (1, "a b c"), (2, None)], schema)
    rows = near_duplicates.near_duplicates(frame).collect()
    assert len(rows) == 5
    assert {r.class_id for r in rows if r.text_hash != 42} == {1}
    assert near_duplicates.drop_near_duplicates(frame).count() == 2
    assert near_duplicates.near_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_dropping_sorts_no_whole_rows(spark):
    frame = spark.createDataFrame([(i, f"one two three four five {i}", "a") for i in range(20)], "doc_id long, text string, source string")
    kept = near_duplicates.drop_near_duplicates(frame)
    plan = kept._jdf.queryExecution().sparkPlan().toString()
    assert "ShuffledHashJoin" in plan and "Sort" not in plan
    again = frame.union(frame.filter("doc_id < 3"))  # their rows are there twice
    assert sorted(near_duplicates.drop_near_duplicates(again).collect()) == sorted(kept.collect()) == sorted(frame.collect())


def test_a_lower_threshold_is_refused(spark):
    frame = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    with pytest.raises(ValueError, match="0.8"):
        near_duplicates.near_duplicates(frame, threshold=0.6)


def test_components_and_further_links(spark):
    draw = np.random.default_rng(9)
    links = [(int(a), int(b)) for a, b in draw.integers(0, 300, (180, 2))] + [(1000, n) for n in range(400, 520)] + [(2000 + n, 2001 + n) for n in range(40)]
    more = [(3, 450), (2000, 7), (9001, 9002)]

    def brute(pairs):
        top = {n: n for pair in pairs for n in pair}

        def find(x):
            while top[x] != x:
                x = top[x]
            return x

        for a, b in pairs:
            top[max(find(a), find(b))] = min(find(a), find(b))
        return {n: find(n) for n in top}

    first = components.components(spark.createDataFrame([p for p in links if p[0] != p[1]], "a long, b long"))
    got = {r.node: r.component for r in first.collect()}
    assert got == brute([p for p in links if p[0] != p[1]])
    between = [(got.get(a, a), got.get(b, b)) for a, b in more]
    after = {r.node: r.component for r in components.merged(first, spark.createDataFrame(between, "a long, b long")).collect()}
    assert after == brute([p for p in links if p[0] != p[1]] + more)
