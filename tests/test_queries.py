"""Every registered query against its DuckDB oracle, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as E

from .conftest import SF_SMALL
from .oracle_util import compare, duckdb_for

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duckdb_for(SF_SMALL)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "actors" in df.columns and "id" in df.columns


def test_every_query_has_oracle_or_reason():
    assert set(ORACLE) <= set(QUERIES)
    # the training-data queries are checked in their own tests
    assert not [q for q in set(QUERIES) - set(ORACLE) if q != "pipeline" and not q.startswith("op")]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), con, ORACLE[name])
    assert ok, msg
