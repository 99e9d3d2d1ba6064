from orderloom.operators.aggregates import (
    customer_value,
    daily_count,
    key_total,
    largest,
    revenue_by,
    trailing_average,
)
from orderloom.operators.dedupe import keep_latest, keep_one
from orderloom.operators.joins import hot_keys, spread_join

__all__ = [
    "customer_value",
    "daily_count",
    "hot_keys",
    "keep_latest",
    "keep_one",
    "key_total",
    "largest",
    "revenue_by",
    "spread_join",
    "trailing_average",
]
