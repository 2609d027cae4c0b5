"""The driver contract: every query runs on the smallest tables, and DuckDB gives the same rows."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
OWN = [k for k in __spark_entry__.queries() if k.startswith("q_")]


def rows(frame):
    def plain(v):
        if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
            return None
        v = v.item() if hasattr(v, "item") else v
        return round(float(v), 9) if isinstance(v, (int, float)) and not isinstance(v, bool) else v

    frame = frame[sorted(frame.columns)]
    return sorted((tuple(map(plain, r)) for r in frame.itertuples(index=False, name=None)), key=repr)


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["min_freq", "min_count", "min_bc3", "consensus", "barcodes_count"]


@pytest.mark.parametrize("name", OWN)
def test_query(spark, name):
    got = __spark_entry__.queries()[name](spark, SF).toPandas()
    sql = __spark_entry__.oracle_sql().get(name)
    if not sql:
        assert len(got)
        return
    with duckdb.connect() as c:
        for f in os.listdir(SF):
            c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
        want = c.sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)
