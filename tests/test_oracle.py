"""Every registered query against its SQL, on the smallest tables."""

import pytest
from compare import SF, compare, connect

import __spark_entry__ as entry

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    n_rows, problem = compare(spark, con, SF, QUERIES[name], ORACLE.get(name))
    assert problem == ""
    assert n_rows > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_is_the_kpi_mart(spark):
    assert entry.entry(spark).columns == [
        "client_id", "current_age", "gender", "total_amount", "transaction_count", "avg_spent", "max_spent",
    ]
