import pytest
from oracle import compare

from cadenza.llm import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_sql(spark, data, name):
    compare(spark, data, queries.QUERIES[name], queries.SQL[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_runs(spark, data, name):
    assert queries.QUERIES[name](spark, data).count() > 0
