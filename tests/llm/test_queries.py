"""Registered queries against their SQL on the same tables."""

import pytest

from tests.oracle import DATA, compare
from tickloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    assert compare(spark, queries.QUERIES[name], queries.ORACLE[name], str(DATA / "sf0.01")) > 0
