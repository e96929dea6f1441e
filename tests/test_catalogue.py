"""Every registered query against its SQL, and the entry points."""

import pytest
from conftest import SMALL
from oracle import compare

import __spark_entry__ as entry_points
from opsframe.plans.catalogue import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    good, found = compare(spark, duck, name, SMALL)
    assert good, found


def test_entry_has_rows(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["metric", "ts", "mean", "lo", "hi", "x_hours", "title"]
    assert result.count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
