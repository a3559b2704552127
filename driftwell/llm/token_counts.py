"""Token counts of whole texts by rank-synchronous array merging.

Texts are cut into pre-tokens; the new ones of a batch are held as ragged numpy arrays (flat symbols and
owners), every round applies each pre-token's lowest-rank pair to all of them at once, and the symbols that
survive are counted (see ``merges``). Special strings inside a text count as one token each.

A null or empty text has 0 tokens. Texts and pre-tokens of any length, repeated rows and other columns of
any name are fine; the output column replaces one of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwell.llm.codes import runs, small_batches
from driftwell.llm.merges import WordStore, load

#: Fixed value: the public pattern of the byte-level vocabulary.
PRE_TOKENS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def pre_tokens(merges, text: str) -> list[str]:
    found = []
    for special, part in merges.pieces(text):
        if special:
            found.append("\0" + part)
        else:
            found += PRE_TOKENS.findall(part)
    return found


def count_tokens(df: DataFrame, path: str, text: str = "text", n_tokens: str = "n_tokens") -> DataFrame:
    """Adds the column ``n_tokens`` (long)."""
    small_batches(df.sparkSession)

    @F.arrow_udf("long")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        merges = load(path)
        store = WordStore(merges)
        for batch in batches:
            counts = [np.empty(0, np.int64)]
            for texts in runs(batch.to_pylist()):
                parts = [pre_tokens(merges, t) for t in texts]
                places = store.places([p for doc in parts for p in doc])
                upto = np.concatenate(([0], np.cumsum(store.lengths[places])))
                ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
                counts.append(np.diff(upto[np.concatenate(([0], ends))]))
            yield pa.array(np.concatenate(counts))

    return df.withColumn(n_tokens, counted(F.col(f"`{text}`")))
