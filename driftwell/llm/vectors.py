"""Vectors as whole numbers: which rows take part, and their components in flat arrays.

A component x becomes floor(factor * x), taken in double precision and held within ``LARGEST`` either way, so
that no sum or squared distance overflows (a component that large is no embedding's).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

LARGEST = 1 << 22


def usable(vector: str) -> Column:
    """Not null, and neither null nor non-finite components."""
    odd = F.exists(F.col(f"`{vector}`"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(f"`{vector}`").isNotNull() & ~odd


def whole_numbers(vectors: pa.Array, factor: int) -> tuple[np.ndarray, np.ndarray]:
    """All components one after the other as int32, and each vector's length."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.clip(np.floor(values * factor), -LARGEST, LARGEST).astype(np.int32), lengths


def padded(values: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """One row per vector, zeros behind the shorter ones."""
    out = np.zeros((len(lengths), width), dtype=np.int32)
    out[np.arange(width) < lengths[:, None]] = values
    return out
