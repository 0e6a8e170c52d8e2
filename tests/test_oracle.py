"""Every query against its SQL, and the driver contract."""

import re

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference

# the queries of the optional subpackage have tests of their own
OPTIONAL = re.compile(r"op\d+_|pipeline$")
SQL = {name: sql for name, sql in entry.oracle_sql().items() if not OPTIONAL.match(name)}
# run on the larger tables too: ties, several row groups, hot values
LARGER = (
    "shapiro_wilk", "dunn_posthoc", "boxplot_stats", "descriptive_report", "dedup_keep_first", "take_whole_pages",
    "aspect_bigrams", "language_id", "review_card_extract", "pb2",
)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())
    assert {name for name in entry.queries() if not OPTIONAL.match(name)} - set(SQL) == {"tukey_limits"}


def test_entry(spark):
    row = entry.entry(spark).collect()
    assert len(row) == 1 and row[0]["k"] == 3


@pytest.mark.parametrize("name", sorted(SQL))
def test_tiny(spark, tiny, name):
    assert difference(entry.queries()[name](spark, tiny), connect(tiny), SQL[name]) is None


@pytest.mark.parametrize("name", LARGER)
def test_small(spark, small, name):
    assert difference(entry.queries()[name](spark, small), connect(small), SQL[name]) is None


def test_comparison_notices_a_changed_value(spark, tiny):
    con = connect(tiny)
    changed = SQL["negative_rate"].replace("avg(negative", "0.000001 + avg(negative")
    assert difference(entry.queries()["negative_rate"](spark, tiny), con, changed) is not None


def test_results_have_rows(spark, tiny):
    empty = [name for name in SQL if entry.queries()[name](spark, tiny).isEmpty()]
    assert empty == []
