"""Values far from the mean of their group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermetrics.schemas import Z


def value_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Mean and population standard deviation of ``value`` per group."""
    return df.groupBy(group).agg(
        F.avg(value).alias("mean"),
        F.coalesce(F.stddev_pop(value), F.lit(0.0)).alias("stddev"),
    )


def expected_range(stats: DataFrame, z: float = Z) -> DataFrame:
    """Add ``mean - z * stddev`` and ``mean + z * stddev``."""
    return stats.withColumns({
        "expected_low": F.col("mean") - F.lit(float(z)) * F.col("stddev"),
        "expected_high": F.col("mean") + F.lit(float(z)) * F.col("stddev"),
    })


def flag_outliers(df: DataFrame, group: str, value: str, z: float = Z) -> DataFrame:
    """Rows strictly more than ``z`` deviations from their group's mean.

    Groups without spread are never flagged. The statistics are an aggregate joined
    back on the group: one row per group, which Spark broadcasts when it measures it
    as small, so a large group is never gathered in one task.
    """
    ranges = expected_range(value_stats(df, group, value), z).filter("stddev > 0")
    deviation = F.abs(F.col(value) - F.col("mean"))
    return df.join(ranges, group).filter(deviation > F.lit(float(z)) * F.col("stddev"))
