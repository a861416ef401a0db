"""Plan guards: nothing runs in one task, as a cross join, or in Python that need not."""

from pathlib import Path

import pytest

from shopmill.registry import QUERIES
from shopmill.sources.tpch import open_shop

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")

# Global aggregates (totals, calendar bounds) end in one row; these windows run over one row per day, month or lookup name.
ONE_TASK_IS_SHORT = {
    "r01_totals", "r06_average_order_value", "r09_shipment_performance", "r10_running_sales",
    "r11_monthly_growth", "running_sales", "mom_growth", "avg_price", "avg_orders_per_month",
    "global_totals", "date_bounds", "distinct_customers", "cast_rejects", "fk_report",
    "integrity_report", "profile_counts", "profile_nulls_sum", "profile_nulls_count", "profile_schema",
    "read_next_id", "r02_monthly_sales", "ingest_summary", "union_counts", "dim_category", "dim_payment_method", "dim_order_status", "dim_date",
}
# Left joins look for hot keys in one sketch of fixed size per task; rejects are counted in one row per task.
ONE_TASK_IS_SHORT |= {
    "orders_payments_left", "orders_shipments_left", "products_suppliers_left", "csv_rejects", "event_rejects",
    "references_one_pass",
}
WRITES = {
    "csv_roundtrip", "csv_multiline", "partition_roundtrip", "append_events", "write_events",
    "ingest_batch", "ingest_stream", "curated_marts", "ingest_summary", "read_since", "star_with_events",
}


def _plan(spark, name):
    return QUERIES[name].run(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def _uses_small_lookup(name, plan):
    # Category, status and method ids come from a window over the distinct names.
    return "Window [row_number()" in plan and "SinglePartition" in plan and any(
        c in plan for c in ("p_type", "o_orderpriority", "o_orderstatus")
    )


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_no_cross_join_no_python_no_single_task(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan and "Python" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    if name not in ONE_TASK_IS_SHORT and not _uses_small_lookup(name, plan):
        # A global rank gathers one summary row per range, never the ranked rows.
        lines = plan.splitlines()
        one = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
        assert all("_range" in lines[i + 1] and "_c" in lines[i + 1] for i in one), plan


def test_scans_read_only_needed_columns(spark):
    plan = _plan(spark, "sales_by_month")
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_extendedprice:double>" in plan


def test_references_read_the_child_once_and_shuffle_none_of_it(spark):
    plan = _plan(spark, "references_one_pass")
    assert plan.count("Scan parquet") == 3 and plan.count("BroadcastHashJoin") == 2  # the child and two sets
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_filters_reach_the_scan(spark):
    assert "EqualTo(o_orderkey,77)" in _plan(spark, "get_event")
    assert "GreaterThanOrEqual(o_orderkey,100)" in _plan(spark, "read_next_id")


def test_top_k_is_not_a_sort(spark):
    assert "TakeOrderedAndProject" in _plan(spark, "top10_customers")


def test_one_row_per_order_meets_the_headers(spark):
    """Lines are summed before the join, so a hot order is one row in it."""
    star = open_shop(spark, FOLDER).star
    from shopmill.plans import reports

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = reports.monthly_sales(star)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = plan.index("SortMergeJoin [order_id")
    assert "partial_sum" in plan[join:]
    # aggregate and join share one shuffle by order id on each side
    assert plan[join:].count("Exchange hashpartitioning(order_id") == 2
