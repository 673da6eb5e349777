"""Registered queries against their check SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.check import differences, duck

@pytest.fixture(scope="module")
def con(small):
    return duck(small)


@pytest.mark.parametrize("name", [n for n in entry.queries() if n.startswith("q_")])
def test_query_agrees_with_sql(spark, con, small, name):
    assert differences(spark, con, small, name) is None


def test_every_check_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark, small):
    result = entry.entry(spark)
    assert "total_registros" in result.columns and not result.isEmpty()
