"""Grouped totals, top-k and the trailing average. Each grouping aggregates in the
map task first, so a hot key sends one row per task into the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.money import total


def key_total(df: DataFrame, key: str, amount: Column, name: str) -> DataFrame:
    """Sum per key. NULL amounts are skipped; a key with only NULLs sums to NULL."""
    return df.groupBy(key).agg(total(df, amount).alias(name))


def revenue_by(df: DataFrame, keys: list[str], revenue: Column, name: str = "revenue") -> DataFrame:
    """Sum per combination of keys; a NULL key is a group of its own."""
    return df.groupBy(*keys).agg(total(df, revenue).alias(name))


def customer_value(order_grain: DataFrame, customer: str, amount: str) -> DataFrame:
    return key_total(order_grain, customer, F.col(amount), "lifetime_value")


def largest(df: DataFrame, value: str, tie_break: str, rows: int) -> DataFrame:
    """Top rows by value, ties by key. Each task keeps ``rows`` candidates."""
    return df.orderBy(F.desc(value), F.asc(tie_break)).limit(rows)


def daily_count(order_grain: DataFrame, day: str, order_key: str) -> DataFrame:
    """Orders per day. The input has one row per order, so counting rows is the
    distinct count, without the second shuffle of one."""
    return order_grain.groupBy(day).agg(F.count(order_key).alias("order_count"))


def trailing_average(
    daily: DataFrame,
    day: str,
    value: str,
    name: str,
    rows: int,
    *,
    calendar_days: bool = False,
) -> DataFrame:
    """Average over the current and the preceding ``rows - 1`` entries.

    The frame counts rows, so days without an entry do not take a place in it.
    With ``calendar_days`` the frame counts days instead. The input is one row per
    day: a single task handles the window, bounded by the length of the calendar.
    """
    if calendar_days:
        window = Window.orderBy(F.unix_date(day)).rangeBetween(-(rows - 1), 0)
    else:
        window = Window.orderBy(day).rowsBetween(-(rows - 1), 0)
    return daily.withColumn(name, F.avg(value).over(window)).orderBy(day)
