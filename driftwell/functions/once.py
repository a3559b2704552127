"""Keep costly expressions from being evaluated twice."""

from __future__ import annotations

from pyspark.sql import DataFrame


def compute_once(df: DataFrame, **columns: str) -> DataFrame:
    """``df`` plus ``columns`` (SQL expressions), each evaluated a single time per row.

    A filter on a computed column is normally pushed below the projection with the whole
    expression copied into it, once per use. A one-element generator keeps the filter above.
    """
    members = ", ".join(f"'{name}', {value}" for name, value in columns.items())
    return df.selectExpr("*", f"inline(array(named_struct({members})))")
