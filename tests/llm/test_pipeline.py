"""The pipeline's stages on a small table."""

import pytest

from driftwell.session import materialize

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages(spark):
    docs = [(i, f"the cat and dog number {i} were in this house " * 5 + ("mail joe@x.org" if i == 3 else f"at {i}"), "en", "a", 0) for i in range(12)]
    docs += [(100, docs[0][1], "en", "b", 0), (101, "123 456", "en", "b", 0), (102, None, None, None, None), (103, "", "en", "b", 0)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    seen = frame
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, seen, ""), name)
        if name != "bpe":
            assert out.columns == frame.columns
        ids = {r.doc_id for r in out.collect()}
        if name == "language":
            assert ids == {*range(12), 100}
        if name == "near_duplicates":
            assert 0 in ids and 100 not in ids
        if name == "personal_data":
            assert "[EMAIL]" in {r.doc_id: r.text for r in out.collect()}[3]
        seen = out
    assert seen.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
