"""JSON form of one order event."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The fields of an order event. The time stays text, because
# Spark's JSON writer would cut it to milliseconds.
EVENT_SCHEMA = "customer_id string, product_id string, order_amount double, timestamp string"

_BROKEN = "_broken"


def event_json(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields))


def parse_event(text: Column, schema: str = EVENT_SCHEMA) -> Column:
    """Struct of the event fields plus ``_broken``, which holds the text itself
    when it is not valid JSON for the schema."""
    return F.from_json(
        text,
        f"{schema}, {_BROKEN} string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN},
    )


def one_line(text: Column) -> Column:
    """A raw line break in valid JSON can only stand between tokens, so a space
    keeps the meaning and gives one record per line."""
    return F.regexp_replace(text, r"[\r\n]+", " ")
