"""Registered queries against their SQL twins on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import compare, connect

QUERIES, TWINS = queries(), oracle_sql()
# fitted over and over by design; covered by test_plans with smaller settings
SLOW = {"layered_build", "pass_run_id"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", [n for n in TWINS if n not in SLOW])
def test_twin(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), con, TWINS[name]) == []


def test_every_twin_has_a_query():
    assert set(TWINS) <= set(QUERIES)


def test_entry(spark, sf_dir):
    assert entry(spark).count() == 55
