"""Every registered query against its SQL on another engine."""

import pytest

import __spark_entry__ as entry
from verification.compare import compare, connect

SF = "/root/testdata/sf0.001"
# Those of the llm subpackage are tested there.
NAMES = [n for n in entry.queries() if n not in entry.llm_queries()]
SQL = {n: sql for n, sql in entry.oracle_sql().items() if n not in entry.llm_queries()}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(SQL) == set(NAMES)


@pytest.mark.parametrize("name", list(SQL))
def test_query_agrees(spark, con, name):
    ok, _, note = compare(spark, con, entry.queries()[name], SQL[name], SF)
    assert ok, note


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == [
        "recall_year",
        "contamination_category",
        "recall_count",
        "pct_of_year",
    ]
    assert result.count() == 107
