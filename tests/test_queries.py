"""Every registered query has SQL, and the models agree with it."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from checks.catalog import ORACLE, QUERIES
from checks.compare import connect, differences

SF = "/root/testdata/sf0.001"

# The rest, which takes minutes, runs with ``python -m checks.run <sf_dir>``.
CHECKED = [n for n in QUERIES if n.startswith(("m0", "m1", "m2", "s01", "s02_register", "j_sub", "f"))
           and not n.startswith(("m04_dw_f", "m04_dw_t", "m04_dw_y", "m15_scorecard_rollup_market"))]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLE) <= set(entry_points.queries())
    assert len(entry_points.queries()) > 100


@pytest.mark.parametrize("name", CHECKED)
def test_same_as_sql(spark, con, name):
    rows, found = differences(entry_points.queries()[name](spark, SF), con, entry_points.oracle_sql()[name])
    assert not found and rows > 0


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
