"""Send orders out as JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermetrics.functions.order_json import order_json
from ordermetrics.schemas import ORDER_FIELDS


def order_messages(orders: DataFrame) -> DataFrame:
    """One text column ``value``, without a key."""
    return orders.select(order_json(F.struct(*ORDER_FIELDS)).alias("value"))


def publish_orders(orders: DataFrame, fmt: str, path: str | None = None, **options) -> None:
    """Write messages to a topic (``kafka``) or append them to text files."""
    writer = order_messages(orders).write.format(fmt).options(**options)
    if fmt == "kafka":
        writer.save()
    else:
        writer.mode("append").save(path)
