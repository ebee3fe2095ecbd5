"""Column expressions for event time and calendar days (session zone: UTC)."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Epoch millis of 0001-01-01 and 9999-12-31T23:59:59.999, the range Spark's timestamps cover.
FIRST_MILLI = -62135596800000
LAST_MILLI = 253402300799999


def event_time(millis: Column) -> Column:
    """Timestamp of epoch millis.

    A number no calendar date can hold becomes null, so that one bad record
    cannot stop a stream with an overflow.
    """
    return F.when(millis.between(FIRST_MILLI, LAST_MILLI), F.timestamp_millis(millis))


def at_midnight(day: date | str) -> Column:
    """Start of a day as a literal; a malformed date string fails here, on the driver."""
    day = day if isinstance(day, date) else date.fromisoformat(day)
    return F.lit(day).cast("timestamp")


def day_bounds(day: date | str) -> tuple[Column, Column]:
    """Half-open range ``[day, day + 1)``."""
    day = day if isinstance(day, date) else date.fromisoformat(day)
    return at_midnight(day), at_midnight(day + timedelta(days=1))
