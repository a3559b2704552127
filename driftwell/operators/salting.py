"""Joins that stay balanced when one key holds a large share of the rows.

Rows carry ``salts``, the number of parts their key is cut into (1 for nearly all keys). A row goes
to one part, drawn from its own columns so that a re-run task draws alike; the other side is
repeated once per part, which only hot keys make more than once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftwell.config import HOT_ROWS


def salts_for(copies: Column, hot_rows: int = HOT_ROWS) -> Column:
    return F.ceil(copies / F.lit(float(hot_rows))).cast("int")


def row_salt(*distinguishing: str) -> Column:
    return F.pmod(F.xxhash64(*distinguishing), F.col("salts")).cast("int").alias("salt")


def every_salt() -> Column:
    return F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
