"""Order messages as a frame with one text column ``json_str``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ordermetrics.schemas import TOPIC
from ordermetrics.session import pin_utc

# Read options of a topic; callers override any of them. A stream's first start skips
# the history, a batch read takes all of it.
KAFKA_DEFAULTS = {"subscribe": TOPIC}


def decode_payload(messages: DataFrame) -> DataFrame:
    """Binary or text ``value`` to ``json_str``; other columns stay."""
    kept = [c for c in messages.columns if c != "value"]
    return messages.selectExpr(*kept, "CAST(value AS STRING) AS json_str")


def read_orders(
    spark: SparkSession, fmt: str, path: str | None = None, streaming: bool = True, **options
) -> DataFrame:
    """Read messages from a topic (``kafka``), from files (``text``: one message a line), or
    from a table of the catalog (``table``, whose name is ``path``; its messages are in the
    column ``value`` or ``json_str``).

    Options go to the source as given, for example ``maxOffsetsPerTrigger`` and
    ``minPartitions`` for a topic or ``maxFilesPerTrigger`` for files. Connection
    details come from the caller; there are no built-in ones.
    """
    if fmt == "kafka":
        start = {"startingOffsets": "latest"} if streaming else {}
        options = {**KAFKA_DEFAULTS, **start, **options}
    pin_utc(spark)
    reader = (spark.readStream if streaming else spark.read).options(**options)
    if fmt == "table":
        messages = reader.table(path)
        if "value" not in messages.columns:
            messages = messages.withColumnRenamed("json_str", "value")
    else:
        reader = reader.format(fmt)
        messages = reader.load(path) if path else reader.load()
    return decode_payload(messages.select("value"))
