"""Every query with SQL: Spark and DuckDB must agree to the last bit on whole tables."""

import oracle
import pytest
from oracle import DATA

from salesmart.plans.registry import oracle_queries, spark_queries

SQL = oracle_queries()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    problem = oracle.compare(spark_queries()[name](spark, DATA), con, SQL[name])
    assert problem is None, problem


def test_every_query_is_callable_and_entry_has_rows(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
