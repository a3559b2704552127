"""Token ids, decoding and counts against the tokenizers library."""

import random
import time

import pytest
from tokenizers import Tokenizer

from driftwell.llm import bpe, token_counts
from driftwell.llm.merges import load
from driftwell.llm.queries import tokenizer

LETTERS = list("aàáéΣσςİßñ日本語한글кир \t\n\r\x0b\x1c\x85 　'sS1２½.,!?<|>_-´́ǅﬁ😀\x00")


def fuzzed(n=400):
    draw = random.Random(5)
    return ["".join(draw.choices(LETTERS, k=draw.randint(0, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def texts(spark):
    special = ["<|endoftext|>x<|startoftext|> <|endoftext|>", "a" * 5000, "1" * 5000, "'S'sx'LL'll", "", None, "same", "same"]
    rows = list(enumerate(fuzzed() + special))
    return spark.createDataFrame([(i, t, "own", "other") for i, t in rows], "doc_id long, text string, ids string, place string"), dict(rows)


def test_ids_and_decoding_equal_the_library(texts):
    frame, wanted = texts
    path = tokenizer("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    for row in bpe.decode(bpe.encode(frame, path), path).collect():
        ids = library.encode(wanted[row.doc_id] or "", add_special_tokens=False).ids
        assert row.ids == ids
        assert row.decoded == library.decode(ids, skip_special_tokens=False)


def test_counts_equal_the_library(texts):
    frame, wanted = texts
    path = tokenizer("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    for row in token_counts.count_tokens(frame, path).collect():
        assert row.n_tokens == len(library.encode(wanted[row.doc_id] or "", add_special_tokens=False).ids)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(none, tokenizer("word_bpe_49k.json")), tokenizer("word_bpe_49k.json")).count() == 0
    assert token_counts.count_tokens(none, tokenizer("byte_bpe_50k.json")).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_long_words_equal_the_library(name):
    """Words far beyond the rounds, among short ones; a million symbols take seconds."""
    draw = random.Random(6)
    merges, library = load(tokenizer(name)), Tokenizer.from_file(tokenizer(name))
    letters = "".join(draw.choices("etaoinshrdlucmfwypvbgkjqxz", k=1_000_000))
    words = ["short", letters[:700], "a" * 3000, "word", "".join(draw.choices("日本語한글кирß", k=60_000)), letters, "the"]
    begun = time.monotonic()
    ids, counts = merges.encode(words)
    assert time.monotonic() - begun < 30
    ends = counts.cumsum()
    for word, low, high in zip(words, ends - counts, ends, strict=True):
        assert ids[low:high].tolist() == library.encode(word, add_special_tokens=False).ids
