"""Every query with SQL gives the same rows in both engines."""

import math
import os

import duckdb
import numpy as np
import pytest

from loomdoc.plans import queries as plans

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(df):
    def cell(v):
        if v is None or isinstance(v, float) and math.isnan(v):
            return None
        if isinstance(v, (bool, np.bool_)):
            return bool(v)
        if isinstance(v, (float, np.floating)):
            return round(float(v), 9)
        return int(v) if isinstance(v, (int, np.integer)) else str(v)

    df = df[sorted(df.columns)].astype(object)
    return sorted((tuple(map(cell, r)) for r in df.itertuples(index=False, name=None)), key=str)


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", list(plans.oracle_sql()))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, want = plans.queries()[name](spark, SF).toPandas(), con.execute(plans.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", [n for n in plans.queries() if n not in plans.oracle_sql()])
def test_has_rows(spark, name):
    assert plans.queries()[name](spark, SF).count() > 0
