"""What the plans of the registered queries contain, and what they must not."""

import re

import pytest

import __spark_entry__ as contract

LAZY = [
    "silver_orders",
    "daily_revenue_by_category",
    "top10_customers_ltv",
    "rolling_7day_order_volume",
    "orders_clean",
    "order_amount",
    "products_translated",
    "dq_results",
    "dq_gate",
    "dq_orphan_customers",
    "quarantine_rows",
    "order_events_json",
]


def plan(spark, sf_dir, name):
    return contract.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


def read_schemas(text, file_name):
    found = []
    for line in text.splitlines():
        if f"/{file_name}" in line:
            found += re.findall(r"ReadSchema: struct<(.*)>", line)
    return found


@pytest.fixture
def full_text(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    spark.conf.set("spark.sql.debug.maxToStringFields", "200")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    spark.conf.unset("spark.sql.debug.maxToStringFields")


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(shuffled_joins, sf_dir, name):
    text = plan(shuffled_joins, sf_dir, name)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "PythonUDF"):
        assert node not in text


@pytest.mark.parametrize("name", ["silver_orders", "dq_results", "quarantine_rows"])
def test_nothing_is_broadcast_beyond_the_limit(shuffled_joins, sf_dir, name):
    assert "BroadcastHashJoin" not in plan(shuffled_joins, sf_dir, name)


def test_scans_read_only_what_is_used(shuffled_joins, full_text, sf_dir):
    text = plan(shuffled_joins, sf_dir, "daily_revenue_by_category")
    lines = read_schemas(text, "lineitem.parquet")
    assert lines and all("l_shipdate" not in s and "l_quantity" not in s for s in lines)
    assert all("l_discount" not in s for s in lines), "amounts paid are not part of revenue"
    assert "l_orderkey:bigint,l_partkey:bigint" in lines, "one scan finds the hot keys of both joins"
    assert all("o_totalprice" not in s for s in read_schemas(text, "orders.parquet"))


def test_filters_reach_the_scan(spark, full_text, sf_dir):
    text = plan(spark, sf_dir, "order_amount")
    assert "PushedFilters: [IsNotNull(l_returnflag), Not(EqualTo(l_returnflag,R))]" in text
    assert "IsNotNull(o_orderkey), IsNotNull(o_custkey)" in plan(spark, sf_dir, "silver_orders")


def test_each_side_of_a_join_is_exchanged_once(shuffled_joins, sf_dir):
    text = plan(shuffled_joins, sf_dir, "silver_orders")
    for key in ("order_id", "customer_id", "product_id"):
        assert len(re.findall(rf"Exchange hashpartitioning\({key}#\d+L?, _left_bucket", text)) == 2
    # Orders and payments by their key, where they are aggregated and then meet.
    assert len(re.findall(r"Exchange hashpartitioning\(order_id#\d+L?, \d+\)", text)) == 2


def test_daily_rows_are_aggregated_before_the_window(shuffled_joins, sf_dir):
    text = plan(shuffled_joins, sf_dir, "rolling_7day_order_volume")
    window, exchange = text.index("Window"), text.index("Exchange SinglePartition")
    assert window < exchange < text.index("partial_count")
