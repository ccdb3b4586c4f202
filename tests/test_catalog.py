"""Every query with SQL agrees with DuckDB at the smallest scale."""

import pytest
from compare import database, difference

from tidemark.plans.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    assert difference(spark, con, SF, QUERIES[name], ORACLE[name]) is None


def test_every_statement_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0 and set(QUERIES) <= set(entry.queries())
