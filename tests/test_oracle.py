"""Every registered query equals its DuckDB oracle SQL (the driver's gate)."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from crease.plans.catalog import QUERIES
from crease.plans.oracle import ORACLE_SQL
from tests.conftest import SF
from tests.oracle_compare import compare, duck_connection


@pytest.fixture(scope="module")
def duck():
    con = duck_connection(SF["0.01"])
    yield con
    con.close()


def test_every_query_has_oracle():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(ORACLE_SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    ok, msg = compare(spark, duck, name, QUERIES[name], ORACLE_SQL[name], SF["0.01"])
    assert ok, msg
    assert not msg.startswith("0 rows")


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["overall_rank", "batsman", "total_runs", "strike_rate",
                          "batting_average", "performance_tier"]
    assert df.count() == 10
