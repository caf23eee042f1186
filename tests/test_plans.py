"""Plan-shape checks behind the scale claims in the README (read from the physical plan)."""

import pytest

from quarry.plans.testdata import QUERIES
from tests.conftest import SF01

NO_EXPAND = ["kpi_summary", "period_growth", "top_categories", "market_reliability", "cohort_retention",
             "type_breakdown", "top_ltv", "repeat_rate", "filtered_products", "rfm"]
SQL_LIKE = [k for k in QUERIES if not k.startswith(("kmeans", "ols"))]


def plan(spark, name):
    return QUERIES[name](spark, SF01)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NO_EXPAND)
def test_distinct_counts_do_not_expand_rows(spark, name):
    assert "Expand" not in plan(spark, name)


def test_no_python_evaluation_in_any_query(spark):
    for name in SQL_LIKE:
        p = plan(spark, name)
        assert "PythonUDF" not in p and "EvalPython" not in p, name


def test_filters_reach_the_scan_and_columns_are_pruned(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    p = plan(spark, "explorer_orders_set")
    assert "EqualTo(o_orderpriority,1-URGENT)" in p and "GreaterThanOrEqual(o_totalprice,400000.0)" in p
    scan = [line for line in plan(spark, "kpi_summary").splitlines() if "lineitem" in line and "FileScan" in line]
    assert scan and all("l_discount" not in line and "l_tax" not in line for line in scan)


def test_topk_stays_partial(spark):
    assert "TakeOrderedAndProject" in plan(spark, "top_ltv")
    assert "WindowGroupLimit" in plan(spark, "topk_per_group")


def test_global_ntile_has_no_row_level_single_partition(spark):
    """The rows being ranked are neither shuffled nor sorted as a whole: tiles are comparisons to the
    rows at which the order is cut, and only the top 25 are ordered."""
    p = plan(spark, "risk_quartiles")
    assert "Window" not in p and "Exchange" not in p and "TakeOrderedAndProject" in p
    p = plan(spark, "rfm_summary")
    assert "Window" not in p and "SinglePartition" not in p
