"""Clean inputs and join them to one row per order line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.columns import day_of
from orderloom.operators.aggregates import key_total
from orderloom.operators.dedupe import keep_latest
from orderloom.operators.joins import ROWS_PER_BUCKET, default_buckets, hot_keys, spread_join

SILVER_COLUMNS = (
    "order_id",
    "product_id",
    "customer_id",
    "price",
    "freight_value",
    "order_status",
    "order_date",
    "customer_unique_id",
    "product_category_name",
    "product_category_name_english",
    "order_amount",
)


def clean_orders(orders: DataFrame) -> DataFrame:
    """Orders with both keys, one per ``order_id``, with their calendar date.

    Rows without a key go first: a copy without a customer must not displace the
    complete one. Of differing copies the latest purchase is kept.
    """
    unique = keep_latest(
        orders.where("order_id IS NOT NULL AND customer_id IS NOT NULL"),
        ["order_id"],
        ["customer_id", "order_status", "order_purchase_timestamp"],
        by="order_purchase_timestamp",
        labels=("order_status",),
    )
    return unique.select(
        "order_id",
        "customer_id",
        "order_status",
        day_of(unique, "order_purchase_timestamp").alias("order_date"),
    )


def order_amounts(payments: DataFrame) -> DataFrame:
    """What was paid per order, over all its payments."""
    return key_total(payments, "order_id", F.col("payment_value"), "order_amount")


def translate_categories(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with the English category name, NULL where there is none."""
    joined = spread_join(
        products.select("product_id", "product_category_name"),
        translation.select("product_category_name", "product_category_name_english"),
        "product_category_name",
        "left",
        right_keys=translation,
        deal_by=["product_id"],
    )
    return joined.select("product_id", "product_category_name", "product_category_name_english")


def known_orders(*, orders: DataFrame, customers: DataFrame, payments: DataFrame) -> DataFrame:
    """Paid orders of known customers, with person and amount.

    Clean orders and amounts leave their aggregates partitioned by ``order_id``, so
    they meet without another shuffle.
    """
    return spread_join(
        clean_orders(orders).join(order_amounts(payments), "order_id"),
        customers.select("customer_id", "customer_unique_id"),
        "customer_id",
        left_keys=orders,
        right_keys=customers,
        deal_by=["order_id"],
    )


def ordered(known: DataFrame, order_items: DataFrame) -> DataFrame:
    """The known orders that have a line. Lines are reduced to their distinct keys
    in the map task, so neither products nor the long list itself are joined."""
    keys = order_items.select("order_id").where("order_id IS NOT NULL").distinct()
    return known.join(keys, "order_id", "left_semi")


def order_lines(
    *,
    orders: DataFrame,
    customers: DataFrame,
    order_items: DataFrame,
    payments: DataFrame,
    products: DataFrame,
    translation: DataFrame,
) -> DataFrame:
    """One row per order line with order, customer, category and amount paid.

    Everything known per order is joined at order grain first. The far longer list of
    lines meets its products while it is narrow, and the orders last, so that the columns
    of an order are never shuffled once per line and the lines of an order end up
    together: what groups them by order or customer afterwards collapses them in the task.
    Lines of unknown, unpaid or customerless orders drop out; unknown products
    stay, without category.
    """
    min_rows = default_buckets(order_items.sparkSession) * ROWS_PER_BUCKET
    hot = hot_keys(order_items, "order_id", "product_id", min_rows=min_rows)
    described = spread_join(
        order_items.select("order_id", "product_id", "price", "freight_value").where("order_id IS NOT NULL"),
        translate_categories(products, translation),
        "product_id",
        "left",
        left_hot=hot,
        right_keys=products,
        deal_by=["order_id"],
    )
    lines = spread_join(
        described,
        known_orders(orders=orders, customers=customers, payments=payments),
        "order_id",
        left_hot=hot,
        deal_by=["product_id"],
    )
    return lines.select(*SILVER_COLUMNS)
