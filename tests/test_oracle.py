"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import pytest

import __spark_entry__ as E
from tests.harness import compare, duck

SF = os.environ.get("TEMPOLITH_TEST_SF", "/root/testdata/sf0.001")
QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE[name], SF)
    assert r["ok"], r.get("why")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF).count() >= 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and len(df.columns) > 10
