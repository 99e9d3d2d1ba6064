from orderloom.functions.columns import day_of, line_revenue, rounded_amount, utc_text
from orderloom.functions.events import EVENT_SCHEMA, event_json, one_line, parse_event
from orderloom.functions.money import exact_total, total

__all__ = [
    "EVENT_SCHEMA",
    "day_of",
    "event_json",
    "exact_total",
    "line_revenue",
    "one_line",
    "parse_event",
    "rounded_amount",
    "total",
    "utc_text",
]
