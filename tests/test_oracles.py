"""Every registered query against its SQL on the same tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from driftwell.plans.oracles import all_oracles
from driftwell.plans.queries import all_queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{SF_DIR}/events.parquet'")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    def cell(value):
        if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
            return ""
        if isinstance(value, pd.Timestamp):
            return value.isoformat()
        return repr(float(value)) if isinstance(value, float) else str(value)

    columns = sorted(frame.columns)
    return sorted(tuple(cell(v) for v in row) for row in frame[columns].itertuples(index=False))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry.queries()) >= set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, database, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    want = database.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)
    assert len(got) > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
