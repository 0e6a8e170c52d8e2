"""Queries that SQL can express, against it."""

import pytest

import __spark_entry__
from guestlens.llm import oracle
from tests.compare import connect, difference


@pytest.mark.parametrize("name", oracle.oracle_sql())
def test_query_equals_sql(spark, tiny, name):
    assert difference(__spark_entry__.queries()[name](spark, tiny), connect(tiny), oracle.oracle_sql()[name]) is None
