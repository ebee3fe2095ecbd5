"""Messages that are no valid order, as a second stream with its own checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ordermetrics.operators.parse import dead_letter_reasons, parse_orders
from ordermetrics.schemas import TRIGGER


def dead_letter_messages(letters: DataFrame, column: str = "json_str") -> DataFrame:
    """Dead letters as messages: the original text and the reason, in one JSON object."""
    text = F.to_json(F.struct(F.col(column).alias("payload"), "reason"))
    return letters.select(text.alias("value"))


def start_dead_letters(
    messages: DataFrame,
    path: str | None,
    checkpoint: str | None,
    trigger: dict | None = None,
    strict: bool = False,
    fmt: str = "parquet",
    column: str = "json_str",
    **options,
) -> StreamingQuery:
    """Append dead letters with their reason to files, to a topic (``fmt="kafka"`` with its
    options), or print them (``fmt="console"``, the only form that needs no checkpoint)."""
    if not checkpoint and fmt != "console":
        raise ValueError("a durable dead-letter sink needs a checkpoint")
    letters = dead_letter_reasons(parse_orders(messages, column), column, strict)
    if fmt == "kafka":
        letters = dead_letter_messages(letters, column)
    if fmt == "console":
        options = {"truncate": False, **options}
    if checkpoint:
        options = {"checkpointLocation": checkpoint, **options}
    writer = (
        letters.writeStream.queryName(f"dead_letters:{path or fmt}").outputMode("append")
        .format(fmt).options(**options)
        .trigger(**(trigger or {"processingTime": TRIGGER}))
    )
    return writer.start(path) if path else writer.start()
