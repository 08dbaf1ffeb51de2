"""Every registered query of the core against its SQL over the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from corpusloom.plans import queries as Q

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in os.listdir(FOLDER):
        c.sql(f"create view {f.removesuffix('.parquet')} as select * from '{FOLDER}/{f}'")
    return c


def cells(df):
    def cell(v):
        if v is None or v is pd.NaT or v is pd.NA or v != v:
            return None
        return round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return sorted((tuple(cell(v) for v in r) for r in df[sorted(df.columns)].astype(object).itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", [n for n in Q.QUERIES if n in Q.SQL])
def test_query(spark, db, name):
    ours, theirs = Q.QUERIES[name](spark, FOLDER).toPandas(), db.sql(Q.SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert cells(ours) == cells(theirs)


@pytest.mark.parametrize("name", [n for n in Q.QUERIES if n not in Q.SQL])
def test_runs(spark, name):
    assert Q.QUERIES[name](spark, FOLDER).count() > 0
