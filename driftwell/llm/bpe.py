"""BPE encoding and decoding of whole texts by batched merge rounds.

The vocabulary is one of lower-case words with word ends: texts are put into NFC and lower case, cut
into words (white space goes), each word's bytes become symbols, the last one with the word end, and
merge rounds run over all new words of a batch in one flat array (see ``merges``). Special strings in a
text stand for their own tokens. Decoding joins the tokens' strings by one space, as the file names no
decoder.

A null or empty text has no tokens and decodes to ''. Words of any length, repeated rows and other
columns of any name are fine; output columns replace those of the same name. The ids of one run of
texts (about a million code points) and at most 200,000 known words are held at a time.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwell.llm.codes import runs, small_batches
from driftwell.llm.merges import WordStore, load

#: Fixed value: the file's own pattern.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def normalized(text: str) -> str:
    """NFC, then lower case code point by code point (no rule for a final sigma)."""
    text = unicodedata.normalize("NFC", text)
    return text.replace("Σ", "σ").lower()


def words_of(merges, text: str) -> list[str]:
    found = []
    for special, part in merges.pieces(text):
        if special:
            found.append("\0" + part)
        else:
            found += WORDS.findall(normalized(part))
    return found


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds the column ``ids`` (array of int): the token ids of ``text``."""
    small_batches(df.sparkSession)

    @F.arrow_udf("array<int>")
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        merges = load(path)
        store = WordStore(merges)
        for batch in batches:
            parts, offsets = [np.empty(0, np.int32)], [np.zeros(1, np.int64)]
            total = 0
            for texts in runs(batch.to_pylist()):
                words = [words_of(merges, t) for t in texts]
                places = store.places([w for doc in words for w in doc])
                per_word = np.concatenate(([0], np.cumsum(store.lengths[places])))
                ends = per_word[np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))]
                offsets.append(total + ends)
                total += int(per_word[-1])
                parts.append(store.flat_ids(places).astype(np.int32))
            yield pa.ListArray.from_arrays(pa.array(np.concatenate(offsets).astype(np.int32)), pa.array(np.concatenate(parts)))

    return df.withColumn(ids, ids_of(F.col(f"`{text}`")))


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds the column ``decoded``: the strings of the tokens, special ones too, joined by one space."""
    small_batches(df.sparkSession)

    @F.arrow_udf("string")
    def text_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        token = load(path).tokens.__getitem__
        for batch in batches:
            flat, offsets = batch.flatten().to_numpy(zero_copy_only=False), np.cumsum(np.concatenate(([0], batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))))
            yield pa.array([" ".join(map(token, flat[a:b].tolist())) for a, b in zip(offsets, offsets[1:], strict=False)], pa.string())

    return df.withColumn(decoded, text_of(F.col(f"`{ids}`")))
