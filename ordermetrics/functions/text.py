"""Report text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_line(day, orders, revenue, average, flagged, low, high) -> Column:
    """One line of the daily report; low and high are the expected orders per hour."""
    return F.format_string(
        "%s: %d orders, revenue %.2f, average %.2f; %d odd hours (expected %.1f to %.1f)",
        day.cast("string"), orders, F.round(revenue, 2), F.round(average, 2),
        flagged, F.round(low, 1), F.round(high, 1),
    )
