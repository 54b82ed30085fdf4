"""Registered queries vs their DuckDB oracle on the smallest driver tables."""
import os
import re

import duckdb
import pytest

import __spark_entry__ as E
from checks.compare import rows_of

SF = "/root/testdata/sf0.001"
# Training-data queries have their own tests beside their package.
NAMES = sorted(k for k in E.oracle_sql() if not re.match(r"op\d", k))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("events", "documents", "benchmark", "labels", "conversations"):
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF).toPandas()
    odf = con.sql(E.oracle_sql()[name]).df()
    sc, sr = rows_of(sdf)
    oc, orr = rows_of(odf)
    assert sc == oc
    assert sr == orr


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and {"qid", "map", "ndcg", "P_10"} <= set(df.columns)
