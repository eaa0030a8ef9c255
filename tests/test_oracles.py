"""Every registered query against its DuckDB oracle at sf 0.01 (the driver's check)."""

import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck

from conftest import SF_ORACLE

from ringcast.plans.catalog import all_queries as own_queries

QUERIES = {k: v for k, v in entry.queries().items() if k in own_queries()}
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF_ORACLE)
    assert ok, msg


def test_every_query_has_an_oracle_or_is_known_inexact():
    assert {q for q in own_queries() if q not in ORACLES} == {"sql_approx"}


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["event_type", "cnt", "avg_value", "splits_touched"]
