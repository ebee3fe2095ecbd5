"""Bounded samples of labelled rows, the same whatever the partitions are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def bounded(frame: DataFrame, most: int, key: Column, *groups: str) -> DataFrame:
    """At most ``most`` rows of each group, those with the smallest hash of ``key``.

    Groups are counted first, and rows far beyond the bound are left out before any row is
    ranked, so texts of a large group are not sorted.
    """
    mark = F.pmod(F.xxhash64(key), F.lit(1 << 31))
    counts = frame.groupBy(*groups).agg(F.count("*").alias("_n"))
    rows = frame.withColumn("_mark", mark)
    joined = rows.join(F.broadcast(counts), list(groups)) if groups else rows.crossJoin(
        F.broadcast(counts))
    near = joined.filter(F.col("_mark") <= F.lit(float(1 << 31)) * (2.0 * most + 50) / F.col("_n"))
    order = Window.partitionBy(*groups).orderBy("_mark", key) if groups else Window.orderBy(
        "_mark", key)
    return near.withColumn("_rank", F.row_number().over(order)).filter(
        F.col("_rank") <= most).drop("_mark", "_n", "_rank")
