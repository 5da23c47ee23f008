"""The correctness gate: every registered query against its DuckDB SQL."""

import duckdb
import pytest

from __spark_entry__ import entry
from tests.oracle_check import compare
from tablewright.workloads import ORACLE_SQL, QUERIES, TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and "c_custkey" in df.columns


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, SF, name, QUERIES[name], ORACLE_SQL[name])
    assert res["ok"], res
