import pytest
from checks import same

from cliplake.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, data, name):
    same(spark, data, QUERIES[name], SQL[name])


def test_every_query_has_sql_or_its_own_test():
    assert set(SQL) <= set(QUERIES) and not set(QUERIES) - set(SQL)


def test_entry_runs(spark, data):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.queries()) >= set(QUERIES)
