"""Business aggregates over the order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame

from orderloom.config import ROLLING_ROWS, TOP_CUSTOMERS
from orderloom.functions.columns import line_revenue
from orderloom.operators.aggregates import (
    customer_value,
    daily_count,
    largest,
    revenue_by,
    trailing_average,
)
from orderloom.operators.dedupe import keep_one


def daily_revenue_by_category(lines: DataFrame, *, ordered: bool = True) -> DataFrame:
    """Revenue per day and category, from the lines. Orders of any status count. A
    clustered write orders the rows itself and can do without ``ordered``."""
    keys = ["order_date", "product_category_name_english"]
    revenue = revenue_by(lines, keys, line_revenue())
    return revenue.orderBy(*keys) if ordered else revenue


def order_grain(lines: DataFrame) -> DataFrame:
    """One row per order: amounts and dates repeat on the lines of an order and
    must not be added up there. Equal rows collapse first, in a hash aggregate, so
    that no sort sees all lines."""
    columns = ["order_id", "customer_unique_id", "order_date", "order_amount"]
    return keep_one(lines.select(*columns).distinct(), ["order_id"], ["customer_unique_id", "order_date", "order_amount"])


def top_customers(orders: DataFrame, rows: int = TOP_CUSTOMERS) -> DataFrame:
    """Customers who paid most over all their orders."""
    values = customer_value(orders, "customer_unique_id", "order_amount")
    return largest(values, "lifetime_value", "customer_unique_id", rows)


def rolling_order_volume(
    orders: DataFrame, rows: int = ROLLING_ROWS, *, calendar_days: bool = False
) -> DataFrame:
    """Orders per day and their trailing average."""
    return trailing_average(
        daily_count(orders, "order_date", "order_id"),
        "order_date",
        "order_count",
        "rolling_7day_avg_order_volume",
        rows,
        calendar_days=calendar_days,
    )
