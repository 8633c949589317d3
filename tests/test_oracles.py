"""Every registered query against its SQL twin, and what its plan must not hold."""

import os

import pytest

from __spark_entry__ import entry, queries
from tests.oracle import connect, differences
from workload import ORACLES, QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    assert differences(spark, con, SF_DIR, QUERIES[name], ORACLES[name]) is None


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", ["offline_base", "marketplace_month", "coverage_sales", "units_guard", "sell_through_compile"])
def test_plans_stay_inside_the_engine(spark, name):
    plan = queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert banned not in plan


def test_every_query_is_registered():
    assert set(QUERIES) <= set(queries())


def test_the_coverage_job_is_a_query_with_sql():
    assert "coverage_orders" in queries() and "coverage_orders" in ORACLES
