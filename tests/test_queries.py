"""Each query of the core against its SQL in DuckDB, on the smallest tables."""

import os

import pytest

from placeforge.plans import queries as core

FOLDER = "/root/testdata/sf0.001"


def plain(v):
    if v is None or v != v:
        return None
    v = v.item() if hasattr(v, "item") else v
    return round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else v


def rows(df):
    return sorted(repr([plain(v) for v in r]) for r in df[sorted(df.columns)].astype(object).values.tolist())


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", list(core.QUERIES))
def test_query(spark, name):
    got = core.QUERIES[name](spark, FOLDER).toPandas()
    if name not in core.ORACLE_SQL:
        assert len(got.columns)
        return
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(FOLDER):
        con.sql(f"create view {f.split('.')[0]} as select * from '{FOLDER}/{f}'")
    want = con.sql(core.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
