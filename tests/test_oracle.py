"""Every core query against the same in SQL, on the smallest tables; queries without SQL must run."""

import pytest

from corpusloom.plans import registry
from tests.oracle import compare, views

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def db(folder):
    return views(folder)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, folder, db, name):
    assert compare(QUERIES[name](spark, folder), db, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, folder, name):
    df = QUERIES[name](spark, folder)
    assert df.columns and df.count() >= 0


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)
