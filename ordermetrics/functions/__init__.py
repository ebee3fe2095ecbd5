from ordermetrics.functions.order_json import broken_order_json, order_json, order_struct
from ordermetrics.functions.text import day_line
from ordermetrics.functions.times import at_midnight, day_bounds, event_time

__all__ = [
    "at_midnight", "broken_order_json", "day_bounds", "day_line",
    "event_time", "order_json", "order_struct",
]
