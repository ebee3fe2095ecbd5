"""JSON text to typed orders, and the split into valid orders and dead letters.

All functions work on batch and streaming frames alike and need no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ordermetrics.functions.times import event_time
from ordermetrics.schemas import ORDER_SCHEMA

STRICT_FIELDS = ["order_id", "sku", "quantity", "price", "timestamp"]


def parse_orders(raw: DataFrame, column: str = "json_str") -> DataFrame:
    """Add the six order fields; text that is no JSON object gives six nulls.

    The struct is expanded with ``inline`` because a generator is a barrier for
    filters. With ``select("parsed.*")`` Catalyst copies ``from_json`` into every
    filter on a parsed field and each record is parsed up to three times.
    """
    return raw.select("*", F.inline(F.array(F.from_json(column, ORDER_SCHEMA))))


def is_valid(strict: bool = False) -> Column:
    """Whether parsed fields make an order (strict: one with all a metric needs, usable)."""
    valid = F.col("order_id").isNotNull()
    if strict:
        for field in STRICT_FIELDS[1:]:
            valid = valid & F.col(field).isNotNull()
        valid = valid & event_time(F.col("timestamp")).isNotNull()
    return valid


def counted(
    parsed: DataFrame, name: str | Observation, strict: bool = False
) -> DataFrame:
    """``parsed`` as it is, counted while whatever query reads it runs: no scan of its own.

    A batch takes an ``Observation``; a stream a name, under which each batch's progress
    reports the counts. ``read`` is ``valid`` plus ``dead``; ``timeless`` orders are valid but
    in no window.
    """
    valid = is_valid(strict)
    timeless = valid & event_time(F.col("timestamp")).isNull()
    return parsed.observe(
        name, F.count(F.lit(1)).alias("read"), F.count_if(valid).alias("valid"),
        F.count_if(~valid).alias("dead"), F.count_if(timeless).alias("timeless"))


def order_fields(orders: DataFrame) -> DataFrame:
    """Add the time and the revenue of each order."""
    return orders.withColumns({
        "event_time": event_time(F.col("timestamp")),
        "revenue": F.col("quantity") * F.col("price"),
    })


def valid_orders(parsed: DataFrame, strict: bool = False) -> DataFrame:
    """Orders that carry an id (strict: all a metric needs, usable), with time and revenue."""
    return order_fields(parsed.filter(is_valid(strict)))


def exact_revenue(orders: DataFrame, scale: int = 6) -> DataFrame:
    """Orders whose revenue is a decimal, rounded once for each order to ``scale`` places.

    Sums of decimals do not depend on their order, so all that is computed from these orders
    is the same bit by bit, however they are partitioned. A revenue that is not a number or
    has more than 28 digits in all becomes null.
    """
    return orders.withColumn("revenue", F.col("revenue").try_cast(f"decimal(28,{scale})"))


def dead_letters(parsed: DataFrame, strict: bool = False) -> DataFrame:
    """The complement of :func:`valid_orders`; no record is in both or in neither."""
    return parsed.filter(~is_valid(strict))


def letter_reason(column: str = "json_str") -> Column:
    """Why a message is no valid order: the first reason that applies."""
    text = F.col(column)
    reason = (
        F.when(text.isNull(), "null_payload")
        .when(F.trim(text) == "", "empty_payload")
        .when(F.try_parse_json(text).isNull(), "malformed_json")
        .when(~F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT"), "not_an_object")
    )
    for field in STRICT_FIELDS:
        reason = reason.when(F.col(field).isNull(), f"missing_{field}")
    return reason.otherwise("time_out_of_range")


def dead_letter_reasons(
    parsed: DataFrame, column: str = "json_str", strict: bool = False
) -> DataFrame:
    """Dead letters with the first reason that applies."""
    return dead_letters(parsed, strict).withColumn("reason", letter_reason(column))
