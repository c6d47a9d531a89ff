"""Every query with an oracle equals its DuckDB SQL (driver tables, sf0.001)."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tools.check_oracle import compare, duck

ORACLE = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert r["cols_ok"], r
    assert r["rows"] == r["oracle_rows"], r
    assert r["values_ok"], r


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10
    assert df.columns == ["appID", "name", "popularityScore"]
