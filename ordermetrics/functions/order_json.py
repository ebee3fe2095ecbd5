"""Column expressions that write an order as JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ordermetrics.schemas import BROKEN_MARK, CUSTOMER_PREFIX, ORDER_SCHEMA


def order_struct(order_id, customer_number, sku, quantity, price, timestamp) -> Column:
    """Order record with prices rounded half up to cents and ``CUST-n`` customers."""
    values = {
        "order_id": order_id,
        "customer_id": F.concat(F.lit(CUSTOMER_PREFIX), customer_number.cast("string")),
        "sku": sku,
        "quantity": quantity,
        "price": F.round(price, 2),
        "timestamp": timestamp,
    }
    return F.struct(*[values[f.name].cast(f.dataType).alias(f.name) for f in ORDER_SCHEMA])


def order_json(order: Column) -> Column:
    """JSON text of an order; null fields stay visible."""
    return F.to_json(order, {"ignoreNullFields": "false"})


def broken_order_json(text: Column) -> Column:
    """The same text cut off before the quantity, as a faulty sender leaves it."""
    return F.concat(F.substring_index(text, '"quantity"', 1), F.lit(BROKEN_MARK))
