"""What the plans look like to Spark."""

import os

import pytest

from checks import QUERIES
from kpiloom import bindings as b, operators as ops

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="generated tables not present")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_products_or_python(spark):
    for name in QUERIES:
        text = plan_of(QUERIES[name](spark, SF))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        assert "Python" not in text and "Pandas" not in text, name


def test_dates_and_columns_reach_the_scan(spark):
    text = plan_of(ops.start_date_filter(b.order_lines(spark, SF), "closed_at", "1996-01-01").select("order_id"))
    assert "GreaterThanOrEqual(o_orderdate" in text
    assert "l_extendedprice" not in text


def test_growth_windows_see_compacted_orders_only(spark):
    text = plan_of(QUERIES["growth_daily"](spark, SF))
    assert text.index("Window") < text.rindex("HashAggregate")
    assert "Window" not in plan_of(QUERIES["order_flag_window"](spark, SF))


def test_fact_joins_are_never_broadcast(spark):
    text = plan_of(QUERIES["growth_weekly"](spark, SF))
    assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text


def test_window_marts_bound_the_scans(spark):
    """The window's days stand on the date columns of lines, visits and traffic."""
    for name in ("daily_kpis", "rolling_7d", "rolling_28d"):
        text = plan_of(QUERIES[name](spark, SF))
        bounds = [line for line in text.splitlines() if "o_orderdate" in line and "Filter" in line and "subquery" in line.lower()]
        assert len(bounds) >= 4, name
