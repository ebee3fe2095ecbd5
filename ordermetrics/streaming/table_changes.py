"""A keyed table as a stream: what each merge has changed.

The lists of current versions are the table's log. A file stream over their names gives
every merge once, also across restarts, because the stream's own checkpoint remembers the
files it has taken. The partitions of a merge are those whose version differs from the list
before; a batch that takes several merges hands over the latest content only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ordermetrics.operators.daily import daily_summary
from ordermetrics.schemas import TRIGGER
from ordermetrics.session import pin_utc
from ordermetrics.sinks.files import (
    NULL_FOLDER, TABLES, create_tables, current_versions, merge_table, read_versions, versions_at,
)

# Receives the rows of the changed partitions, the partitions (one date each), and the batch id.
Handler = Callable[[DataFrame, DataFrame, int], None]


def merges_of(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Stream of the merges into a declared table, by number."""
    files = (
        spark.readStream.format("binaryFile").option("pathGlobFilter", "*.json")
        .option("ignoreMissingFiles", "true")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .load(f"{root}/{name}/_current")
    )
    return files.select(F.regexp_extract("path", r"(\d+)\.json$", 1).cast("bigint").alias("merge"))


def changed_folders(
    before: dict[str, str] | None, after: dict[str, str],
) -> list[str]:
    """Partition folders that differ between two lists; all where the older is no longer kept."""
    if before is None:
        return sorted(after)
    return sorted(f for f in before.keys() | after.keys() if before.get(f) != after.get(f))


def start_table_changes(
    spark: SparkSession, root: str, name: str, handler: Handler, checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Follow a declared table; ``handler`` must be repeatable, as any batch may run again.

    A follower that is more merges behind than the table keeps gets all partitions.
    """
    create_tables(pin_utc(spark), root)
    table = TABLES[name]

    def apply(batch: DataFrame, batch_id: int) -> None:
        merges = [row.merge for row in batch.collect()]  # at most as many as the table keeps
        if not merges:
            return
        path = f"{root}/{name}"
        before = versions_at(spark, path, min(merges) - 1) if min(merges) > 1 else {}
        after = versions_at(spark, path, max(merges))
        if after is None:  # replaced by so many later merges that it is gone, or not finished
            after = current_versions(spark, path)[1]
        folders = changed_folders(before, after)
        if folders:
            dates = [folder.partition("=")[2] for folder in folders]
            parts = spark.createDataFrame(
                [(None if d == NULL_FOLDER else d,) for d in dates], "d string").select(
                F.to_date("d").alias(table.partition))
            rows = read_versions(spark, root, name, {f: after[f] for f in folders if f in after})
            handler(rows, parts, batch_id)

    writer = (
        merges_of(spark, root, name).writeStream.queryName(f"changes:{path_name(root, name)}")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": TRIGGER}))
        .foreachBatch(apply)
    )
    return writer.start()


def path_name(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def start_daily_summary(
    spark: SparkSession, root: str, checkpoint: str, trigger: dict | None = None,
) -> StreamingQuery:
    """Keep ``daily_summary`` up to date with ``live_metrics``: changed days only, whole days each."""
    def apply(rows: DataFrame, days: DataFrame, batch_id: int) -> None:
        scope = days.select(F.col("window_date").alias("summary_date"))
        merge_table(spark, root, "daily_summary", daily_summary(rows), scope)

    return start_table_changes(spark, root, "live_metrics", apply, checkpoint, trigger)
