"""Viterbi against a plain loop; languages of held-out and mixed texts."""

import numpy as np

from driftwell.llm import language, queries

EN = "the cat and the dog were in the house of this man with that thing "
DE = "der hund und die katze sind nicht in dem haus von einem mann mit ding "
RU = "кошка и собака были в доме этого человека "


def test_viterbi_equals_a_loop():
    draw = np.random.default_rng(0)
    for _ in range(30):
        sizes = draw.integers(0, 300, draw.integers(1, 6))
        starts = np.concatenate(([0], np.cumsum(sizes)))
        if not starts[-1]:
            continue
        scores = draw.normal(size=(starts[-1], draw.integers(1, 5))).astype(np.float32) * 2
        penalty = float(draw.uniform(0, 6))
        labels = language.viterbi(scores, starts, penalty)
        for a, b in zip(starts, starts[1:], strict=False):
            if a == b:
                continue
            best = scores[a].astype(float)
            for t in range(a + 1, b):
                best = scores[t] + np.maximum(best, best.max() - penalty)
            own = labels[a:b]
            got = scores[a:b][np.arange(b - a), own].sum(dtype=float) - penalty * (np.diff(own) != 0).sum()
            assert abs(got - best.max()) < 1e-2 * max(1, abs(best.max()) / 50)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, language string")


def test_spans_scripts_and_odd_rows(spark):
    learned = frame(spark, [(1, EN * 5, "en", "x"), (2, DE * 5, "de", "x"), (3, RU * 5, "ru", "x"), (4, EN, None, "x"), (5, None, "en", "x")])
    model = language.train(learned)
    assert model.languages == ("de", "en", "ru")
    mixed = EN * 2 + DE * 2
    asked = frame(spark, [(1, mixed, None, "x"), (2, "собака", None, "x"), (3, None, None, "x"), (4, "", None, "x"), (5, "12 !", None, "x"), (6, EN * 3000, None, "x"), (6, EN * 3000, None, "x")])
    rows = language.identify(asked, model).orderBy("doc_id").collect()
    got = {r.doc_id: r.language for r in rows}
    assert len(rows) == 7
    assert [s.lang for s in got[1].spans] == ["en", "de"]
    assert abs(got[1].spans[1].start - 2 * len(EN)) < 12
    assert got[2].lang == "ru"
    assert [got[i].lang for i in (3, 4, 5)] == ["und"] * 3
    assert (got[6].lang, got[6].score) == ("en", 1.0)


def test_nothing_learned_and_empty(spark):
    none = frame(spark, [])
    model = language.train(none)
    assert language.identify(frame(spark, [(1, EN, None, "x")]), model).first().language.lang == "und"
    assert language.identify(none, model).count() == 0


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = queries.op2_language(spark, sf_dir).join(truth, "doc_id").filter("held_out AND lang IS NOT NULL").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows) > 0
