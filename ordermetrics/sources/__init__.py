from ordermetrics.sources.feed import lineitem_orders, order_feed
from ordermetrics.sources.metrics_table import hour_predicates, read_live_metrics_jdbc
from ordermetrics.sources.orders import decode_payload, read_orders

__all__ = [
    "decode_payload", "hour_predicates", "lineitem_orders", "order_feed", "read_orders",
    "read_live_metrics_jdbc",
]
