"""Every registered query against its SQL, on the smallest tables."""

import pytest
from conftest import SF, same

from loomline.plans.catalog import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, SF)
    assert same(df.collect(), SQL[name])


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
