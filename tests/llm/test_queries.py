"""Queries of this package that SQL can say, against SQL; the others must run."""

import pytest

from corpusloom.llm import queries
from tests.oracle import compare, views

QUERIES, SQL = queries.queries(), queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, folder, name):
    assert compare(QUERIES[name](spark, folder), views(folder), SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, folder, name):
    assert QUERIES[name](spark, folder).count() >= 0
