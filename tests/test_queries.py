"""Every registered query beside its SQL on the smallest tables, and the shape of its plan."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from __spark_entry__ import entry  # noqa: E402
from entry_queries import QUERIES, SQL  # noqa: E402
from check import compare, connect  # noqa: E402

DIRECTORY = "/root/testdata/sf0.001"
UNWANTED = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas")


@pytest.fixture(scope="module")
def con():
    return connect(DIRECTORY)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    ok, note, _ = compare(spark, con, DIRECTORY, name)
    assert ok, note


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"exp_fit"}))
def test_plan_has_no_cross_join_and_no_python(spark, name):
    plan = QUERIES[name](spark, DIRECTORY)._jdf.queryExecution().executedPlan().toString()
    assert not [p for p in UNWANTED if p in plan]


@pytest.mark.parametrize("name, most", [("count_summary", 2), ("cpue", 4), ("soak_time", 2), ("collapse_events", 2)])
def test_dates_are_parsed_once(spark, name, most):
    """Plans hold one pattern for each date column of a form, and none of the calls that fail by exception."""
    plan = QUERIES[name](spark, DIRECTORY)._jdf.queryExecution().executedPlan().toString()
    assert "gettimestamp" not in plan
    assert len(re.findall(r"regexp_replace\([^()]*, \\A", plan)) <= most


@pytest.mark.parametrize("name, most", [("double_entry_diff", 2), ("two_field_diff", 2), ("distinct_entry_diff", 3), ("full_join_diff", 3), ("full_join_diff_missing", 3)])
def test_reconciliation_shuffles(spark, name, most):
    plan = QUERIES[name](spark, DIRECTORY)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= most


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_runs(spark):
    assert entry(spark).count() > 0


def test_box_and_days_are_pushed_to_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        plans = {
            name: QUERIES[name](spark, DIRECTORY)._jdf.queryExecution().executedPlan().toString()
            for name in ("grid_subset", "daily_regional_mean")
        }
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    for plan in plans.values():
        pushed = plan[plan.index("PushedFilters") : plan.index("ReadSchema")]
        assert "GreaterThanOrEqual(l_quantity,10.0)" in pushed and "LessThanOrEqual(l_quantity,40.0)" in pushed
    assert "l_shipdate,1996-03-01" in plans["grid_subset"]
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_discount:double,l_shipdate:timestamp_ntz>" in plans["daily_regional_mean"]
