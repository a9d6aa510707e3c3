from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
from oracle_check import compare

ROOT = "/root/testdata/sf0.001"
SQL, QUERIES = entry.oracle_sql(), entry.queries()
pytestmark = pytest.mark.skipif(not Path(ROOT).exists(), reason="test tables absent")


def test_every_sql_twin_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, ROOT, QUERIES[name], SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, ROOT).count() > 0


def test_entry_has_rows(spark):
    frame = entry.entry(spark)
    assert frame.count() == 200 and "found_itself" in frame.columns
