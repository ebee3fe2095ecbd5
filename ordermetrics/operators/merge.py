"""Keyed merge as plain DataFrame operations."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_rows(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` with the rows of ``updates`` inserted or put in place of equal keys.

    Keys compare null-safe and are unique on both sides. The target is only
    anti-joined: when Spark measures the updates as small it broadcasts them and the
    target is not shuffled.
    """
    columns = target.columns
    # New attribute ids, so that both sides may come from one source.
    new_keys = updates.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    same_key = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys])
    kept = target.join(new_keys, same_key, "left_anti")
    return kept.select(*columns).unionByName(updates.select(*columns))


def without_scope(target: DataFrame, scope: DataFrame) -> DataFrame:
    """``target`` without the rows whose values stand in ``scope``, compared null-safe."""
    names = scope.columns
    gone = scope.select(*[F.col(c).alias(f"_gone_{c}") for c in names]).distinct()
    return target.join(
        gone, reduce(and_, [F.col(c).eqNullSafe(F.col(f"_gone_{c}")) for c in names]), "left_anti")


def latest_with_version(changes: DataFrame, keys: list[str], version: str) -> DataFrame:
    """For each key its row with the highest ``version``, in the columns of ``changes``."""
    values = [c for c in changes.columns if c not in keys and c != version]
    latest = [F.max_by(c, version).alias(c) for c in values]
    return changes.groupBy(*keys).agg(*latest, F.max(version).alias(version)).select(*changes.columns)


def latest_per_key(changes: DataFrame, keys: list[str], version: str) -> DataFrame:
    """:func:`latest_with_version` without the version."""
    return latest_with_version(changes, keys, version).drop(version)
