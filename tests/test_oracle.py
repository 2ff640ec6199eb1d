import pytest
from oracle import compare

from cadenza.plans import registry


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_against_sql(spark, data, name):
    compare(spark, data, registry.queries()[name], registry.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_runs(spark, data, name):
    df = registry.queries()[name](spark, data)
    assert df.columns
    df.count()


def test_entry(spark, data):
    assert registry.flagship(spark, data).count() > 0
