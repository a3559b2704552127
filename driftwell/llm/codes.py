"""Whole texts as flat arrays of code points, so that numpy can work on many texts at once.

Used inside Arrow UDFs only. A batch is cut into runs of whole texts of about ``CHARS`` code points,
which bounds memory however long the batch is; a single longer text is a run of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np

CHARS = 1 << 20
BATCH_ROWS = 1000  # whole texts that reach a Python worker at once
U64 = np.uint64


@cache
def lower_table() -> np.ndarray:
    """Code point to its lower case (itself where that is not a single code point)."""
    table = np.arange(0x110000, dtype=np.uint32)
    for code in range(0x110000):
        low = chr(code).lower()
        if len(low) == 1:
            table[code] = ord(low)
    return table


@cache
def letter_table() -> np.ndarray:
    """Lower-case code point of letters, 0 of everything else."""
    is_letter = np.fromiter((chr(code).isalpha() for code in range(0x110000)), dtype=bool, count=0x110000)
    return np.where(is_letter, lower_table(), 0).astype(np.uint32)


def small_batches(spark) -> None:
    """Rows of texts are large: at most ``BATCH_ROWS`` of them go into an Arrow batch of this session."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= BATCH_ROWS:
        spark.conf.set(setting, str(BATCH_ROWS))


def runs(texts: list[str | None], chars: int = CHARS) -> Iterator[list[str]]:
    """Consecutive texts, None as empty, in lists of about ``chars`` code points."""
    held, size = [], 0
    for text in texts:
        held.append(text or "")
        size += len(held[-1])
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


def flat_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, a line feed after each, and where each text starts (one more at the end)."""
    joined = "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1, out=starts[1:])
    return codes, starts


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of True."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    return edges[::2], edges[1::2]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions ``start, start + 1, ...`` of all pieces one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - ends + lengths, lengths)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, element by element."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))
