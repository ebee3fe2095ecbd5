"""Parallel scan of a metric table in a database."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from ordermetrics.session import pin_utc


def hour_predicates(first: date, last: date, column: str = "window_start") -> list[str]:
    """One half-open predicate per hour from ``first`` to ``last``, both included."""
    at = datetime.combine(first, datetime.min.time())
    end = datetime.combine(last + timedelta(days=1), datetime.min.time())
    predicates = []
    while at < end:
        after = at + timedelta(hours=1)
        predicates.append(f"{column} >= TIMESTAMP '{at}' AND {column} < TIMESTAMP '{after}'")
        at = after
    return predicates


def read_live_metrics_jdbc(
    spark: SparkSession, options: dict[str, str], first: date, last: date,
    table: str = "live_metrics",
) -> DataFrame:
    """Scan the days ``first`` to ``last`` of a database table, one partition per hour.

    ``options`` holds ``url`` and credentials. Times are stored as UTC wall times and are
    read as such: the zone of the host does not shift them.
    """
    properties = {k: v for k, v in options.items() if k != "url"}
    properties["preferTimestampNTZ"] = "true"
    rows = pin_utc(spark).read.jdbc(
        options["url"], table, predicates=hour_predicates(first, last), properties=properties
    )
    return rows.select(*(
        F.col(f.name).cast("timestamp").alias(f.name)
        if isinstance(f.dataType, TimestampNTZType) else f.name for f in rows.schema))
