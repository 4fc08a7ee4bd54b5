"""Every query against its SQL on a second engine, over whole tables."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
import compare  # noqa: E402

from salesmarts.bound.oracle import all_oracles  # noqa: E402
from salesmarts.bound.queries import all_queries  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def test_every_query_has_sql():
    assert sorted(all_queries()) == sorted(all_oracles())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["year_month", "total_revenue", "order_count", "active_customers"]


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, con, name):
    assert compare.compare(spark, con, SF, name) == ""
