"""Column expressions. All are built-in functions, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rounded_amount(amount: Column) -> Column:
    return F.round(amount, 2)


def line_revenue(price: str = "price", freight: str = "freight_value") -> Column:
    """Price plus freight; NULL when either is NULL."""
    return F.col(price) + F.col(freight)


def day_of(df: DataFrame, name: str) -> Column:
    """Calendar date of a timestamp column. Text that schema inference could not
    type as a timestamp gives NULL where it is no date, in place of a failed job."""
    if dict(df.dtypes)[name] == "string":
        return F.try_to_date(F.col(name))
    return F.to_date(F.col(name))


def utc_text(instant: Column) -> Column:
    """ISO-8601 text with six fractional digits and a ``+00:00`` offset; the
    session time zone has to be UTC."""
    return F.date_format(instant.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
