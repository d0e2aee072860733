import pytest

from vernissage import queries

from .conftest import SF
from .oracle import compare


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_sql(spark, name):
    compare(spark, name, queries.QUERIES[name], queries.ORACLES[name], SF)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert queries.QUERIES[name](spark, SF).count() >= 0
