from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from orderloom.plans import silver
from orderloom.workload.queries import QUERIES

DAY = datetime(2017, 3, 4, 23, 59, 59)


def frames(spark, **changed):
    rows = {
        "orders": [("o1", "c1", "delivered", DAY), ("o2", "c2", "canceled", DAY)],
        "customers": [("c1", "u1"), ("c2", "u1")],
        "order_items": [("o1", "p1", 10.0, 1.0), ("o1", "p2", 20.0, 2.0), ("o2", "p1", 5.0, 0.5)],
        "payments": [("o1", 30.1), ("o1", 2.9), ("o2", 5.5)],
        "products": [("p1", "brinquedos"), ("p2", None)],
        "translation": [("brinquedos", "toys")],
    }
    schemas = {
        "orders": "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp",
        "customers": "customer_id string, customer_unique_id string",
        "order_items": "order_id string, product_id string, price double, freight_value double",
        "payments": "order_id string, payment_value double",
        "products": "product_id string, product_category_name string",
        "translation": "product_category_name string, product_category_name_english string",
    }
    rows.update(changed)
    return {name: spark.createDataFrame(data, schemas[name]) for name, data in rows.items()}


def lines_of(spark, **changed):
    return silver.order_lines(**frames(spark, **changed))


def test_columns_and_values(spark):
    lines = lines_of(spark)
    assert tuple(lines.columns) == silver.SILVER_COLUMNS
    rows = {(r.order_id, r.product_id): r for r in lines.collect()}
    assert len(rows) == 3
    toy = rows["o1", "p1"]
    assert toy.order_amount == 33.0 and toy.product_category_name_english == "toys"
    assert toy.order_date == date(2017, 3, 4) and toy.customer_unique_id == "u1"
    assert rows["o1", "p2"].product_category_name is None
    assert rows["o2", "p1"].order_status == "canceled"


def test_order_without_payment_drops_out(spark):
    lines = lines_of(spark, payments=[("o2", 5.5)])
    assert [r.order_id for r in lines.collect()] == ["o2"]


def test_payment_of_null_only_keeps_the_order(spark):
    lines = lines_of(spark, payments=[("o2", None)])
    assert [(r.order_id, r.order_amount) for r in lines.collect()] == [("o2", None)]


def test_order_without_customer_or_items_drops_out(spark):
    assert {r.order_id for r in lines_of(spark, customers=[("c2", "u1")]).collect()} == {"o2"}
    assert {r.order_id for r in lines_of(spark, order_items=[("o2", "p1", 1.0, 1.0)]).collect()} == {"o2"}


def test_unknown_product_and_category_stay_without_name(spark):
    items = [("o1", "nowhere", 1.0, 1.0), ("o2", "p1", 1.0, 1.0), ("o2", None, 2.0, 1.0)]
    lines = lines_of(spark, order_items=items, translation=[("other", "other")]).collect()
    assert len(lines) == 3 and all(r.product_category_name_english is None for r in lines)
    assert {r.product_category_name for r in lines} == {None, "brinquedos"}


def test_repeated_customer_fans_out(spark):
    lines = lines_of(spark, customers=[("c1", "u1"), ("c1", "u2"), ("c2", "u3")])
    assert lines.where("order_id = 'o1'").count() == 4


@pytest.mark.parametrize("joins", ["spark", "shuffled_joins"])
def test_same_lines_with_and_without_broadcast(request, joins):
    spark = request.getfixturevalue(joins)
    items = [("o1", f"p{i % 3}", float(i), 0.25) for i in range(300)] + [(None, "p1", 1.0, 1.0)]
    lines = lines_of(spark, order_items=items)
    assert lines.count() == 300
    assert lines.where("product_category_name_english = 'toys'").count() == 100


def test_incomplete_copy_does_not_displace_the_order(spark):
    orders = [("o1", None, "delivered", datetime(2018, 1, 1)), ("o1", "c1", "delivered", DAY), (None, "c1", "x", DAY)]
    clean = silver.clean_orders(frames(spark, orders=orders)["orders"]).collect()
    assert [(r.order_id, r.customer_id) for r in clean] == [("o1", "c1")]


def test_latest_copy_is_kept_whole(spark):
    orders = [
        ("o1", "c1", "shipped", datetime(2017, 1, 1)),
        ("o1", "c0", "approved", datetime(2017, 1, 2)),
        ("o1", "c9", "created", None),
    ]
    for arrangement in (orders, orders[::-1]):
        row = silver.clean_orders(frames(spark, orders=arrangement)["orders"]).collect()
        assert [tuple(r) for r in row] == [("o1", "c0", "approved", date(2017, 1, 2))]


def test_text_dates_that_are_none_become_null(spark):
    orders = spark.createDataFrame(
        [("o1", "c1", "x", "2017-05-06 10:00:00"), ("o2", "c1", "x", "soon")],
        "order_id string, customer_id string, order_status string, order_purchase_timestamp string",
    )
    days = {r.order_id: r.order_date for r in silver.clean_orders(orders).collect()}
    assert days == {"o1": date(2017, 5, 6), "o2": None}


def test_lines_of_an_order_are_together(shuffled_joins, sf_dir):
    spark = shuffled_joins
    lines = QUERIES["silver_orders"](spark, sf_dir)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = lines.select("order_id", F.spark_partition_id().alias("part")).distinct().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len({r["part"] for r in parts}) == 4
    assert len(parts) == len({r["order_id"] for r in parts})
