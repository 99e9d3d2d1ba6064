from orderloom.streaming.commits import Totals, landed_totals
from orderloom.streaming.orders import (
    StreamCounts,
    compact_landing,
    compact_printed_landing,
    drain,
    land_and_print,
    land_orders,
    read_batches,
    read_printed,
    route_events,
)

__all__ = [
    "StreamCounts",
    "Totals",
    "compact_landing",
    "compact_printed_landing",
    "drain",
    "land_and_print",
    "land_orders",
    "landed_totals",
    "read_batches",
    "read_printed",
    "route_events",
]
