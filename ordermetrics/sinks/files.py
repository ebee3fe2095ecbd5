"""Keyed tables as partitioned parquet.

A merge rewrites only the partitions its updates fall into, and writes each of them to a
new folder: ``<table>/<partition>=<date>/version=<n>``. A small file then names the
current version of every partition; readers look only there. Creating that file is the
last step and the only one that shows, so a reader never sees half a merge, a crash
anywhere leaves the table as it was, and repeating a merge is always safe. Replaced
folders stay for ``KEPT_VERSIONS`` merges, for queries that started on them.

Several writers may merge at once. The file of merge n is created exclusively, so one
writer gets the number; the others look at what changed since they read the table. If
their own partitions are untouched they take the next number, else they merge again.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from dataclasses import dataclass
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from ordermetrics import schemas
from ordermetrics.operators.merge import merge_rows, without_scope
from ordermetrics.session import PRUNABLE_TIMES, pin_utc, settings

# Merges whose content stays readable; what only older ones name is deleted.
KEPT_VERSIONS = 20
# Seconds to wait for another writer that has taken a number and not finished its file.
PATIENCE = 60
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _hadoop_path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _hadoop_path(spark, path)
    return fs.exists(hadoop)


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop = _hadoop_path(spark, path)
    fs.delete(hadoop, True)


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; none where it does not exist."""
    fs, hadoop = _hadoop_path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(hadoop)] if fs.exists(hadoop) else []


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Partition folders directly below ``path``."""
    return [name for name in file_names(spark, path) if "=" in name]


def current_versions(spark: SparkSession, path: str) -> tuple[int, dict[str, str]]:
    """Number of the last merge, and the current version of each partition folder.

    A file whose writer has not finished it is no merge yet.
    """
    for number in reversed(merge_numbers(spark, path)):
        versions = versions_at(spark, path, number)
        if versions is not None:
            return number, versions
    return 0, {}


def merge_numbers(spark: SparkSession, path: str) -> list[int]:
    """The merges whose list of versions is kept, oldest first."""
    return sorted(int(n.removesuffix(".json")) for n in file_names(spark, f"{path}/_current")
                  if n.endswith(".json"))


def versions_at(spark: SparkSession, path: str, number: int) -> dict[str, str] | None:
    """The versions after one merge; None where the list is unfinished or no longer kept."""
    file = f"{path}/_current/{number:012d}.json"
    text = text_of(spark, file) if exists(spark, file) else ""
    if not text.endswith("}"):
        return None
    return {folder: str(version) for folder, version in json.loads(text).items()}


def text_of(spark: SparkSession, path: str) -> str:
    fs, hadoop = _hadoop_path(spark, path)
    stream = fs.open(hadoop)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_exclusively(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file ``path``; False if it is there already. Of several callers one succeeds.

    On a local disk a finished draft gets the name as a second link, which the system grants
    once. Elsewhere the file system itself refuses to create a file twice.
    """
    fs, hadoop = _hadoop_path(spark, path)
    fs.mkdirs(hadoop.getParent())
    if fs.getScheme() == "file":
        final = Path(fs.makeQualified(hadoop).toUri().getPath())
        draft = final.with_name(f".{uuid.uuid4().hex}.draft")
        draft.write_text(text)
        try:
            os.link(draft, final)
        except FileExistsError:
            return False
        finally:
            draft.unlink()
        return True
    if fs.exists(hadoop):
        return False
    try:
        out = fs.create(hadoop, False)
    except Py4JJavaError as failure:
        if "FileAlreadyExists" in failure.java_exception.getClass().getName() or fs.exists(hadoop):
            return False
        raise
    out.write(text.encode())
    out.close()
    return True


def _commit(
    spark: SparkSession, path: str, base: tuple[int, dict[str, str]], changes: dict[str, str | None],
) -> int | None:
    """Make ``changes`` (folder to new version, None for gone) current; returns the merge's number.

    ``base`` is what they were made from. None, and nothing is changed, if another merge has
    since replaced one of the same folders, or so many came that a folder written for this one
    may be gone: then the caller has to merge again.
    """
    number, versions = base
    waited = 0.0
    while True:
        last, current = current_versions(spark, path)
        taken = max(merge_numbers(spark, path), default=0)
        if any(current.get(f) != versions.get(f) for f in changes) or last >= number + KEPT_VERSIONS:
            return None
        if taken > last:  # another writer is about to finish its file
            if waited >= PATIENCE:
                raise OSError(f"merge {taken} of {path} is unfinished; remove its file if its writer is gone")
            time.sleep(0.1)
            waited += 0.1
            continue
        after = {f: v for f, v in {**current, **changes}.items() if v is not None}
        if create_exclusively(spark, f"{path}/_current/{last + 1:012d}.json", json.dumps(after)):
            delete(spark, f"{path}/_current/{last + 1 - KEPT_VERSIONS:012d}.json")
            return last + 1


def _with_partition(schema: StructType, partition: str) -> StructType:
    return StructType([*schema.fields, StructField(partition, DateType())])


def _read(
    spark: SparkSession, path: str, schema: StructType, versions: dict[str, str]
) -> DataFrame:
    """The rows of some partition folders; ``schema`` includes the partition column."""
    if not versions:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/{name}/version={version}" for name, version in versions.items()]
    stored = StructType([*schema.fields, StructField("version", StringType())])
    return spark.read.schema(stored).option("basePath", path).parquet(*folders).drop("version")


def merge_into(
    spark: SparkSession, path: str, updates: DataFrame, keys: list[str],
    schema: StructType, partition: str, partition_value: Column, scope: DataFrame | None = None,
) -> None:
    """Insert ``updates`` into the table at ``path``, overwriting rows with equal keys.

    ``partition_value`` is a date that follows from the keys; the table is partitioned by
    it under the name ``partition``. ``scope`` holds values of some of the keys, enough for
    the partition, or of the partition itself: stored rows with such values that ``updates``
    does not name are removed, so the updates are all there is for them. Rows outside of the
    scope are never removed.
    """
    incoming = updates.select(*schema.fieldNames()).withColumn(partition, partition_value)
    incoming = incoming.persist()
    removed = None if scope is None else (
        scope if partition in scope.columns else scope.withColumn(partition, partition_value)).persist()
    try:
        dates = {row[0] for row in incoming.select(partition).distinct().collect()}
        if removed is not None:
            dates |= {row[0] for row in removed.select(partition).distinct().collect()}
        folders = {f"{partition}={NULL_FOLDER if d is None else d}" for d in dates}
        while folders:
            base = current_versions(spark, path)
            stored = _read(spark, path, _with_partition(schema, partition),
                           {f: v for f, v in base[1].items() if f in folders})
            if removed is not None:
                stored = without_scope(stored, removed.select(*scope.columns))
            # A crashed or beaten attempt's folders are never taken for those of a later one.
            version = f"{base[0] + 1}-{uuid.uuid4().hex[:12]}"
            merged = merge_rows(stored, incoming, keys).hint("rebalance", partition).withColumn(
                "version", F.lit(version))
            # The default timestamps carry no statistics, so time filters would read everything.
            with settings(merged.sparkSession, PRUNABLE_TIMES):
                merged.write.mode("overwrite").option(
                    "partitionOverwriteMode", "dynamic").partitionBy(partition, "version").parquet(path)
            # A partition that lost its last row has no folder.
            changes = {f: version if exists(spark, f"{path}/{f}/version={version}") else None
                       for f in folders}
            number = _commit(spark, path, base, changes)
            if number is not None:
                _delete_unnamed(spark, path, folders, number)
                return
            for folder in folders:
                delete(spark, f"{path}/{folder}/version={version}")
    finally:
        incoming.unpersist()
        if removed is not None:
            removed.unpersist()


def _delete_unnamed(spark: SparkSession, path: str, folders: set[str], number: int) -> None:
    """Remove content of just replaced partitions that no kept list of versions names.

    A folder younger than the kept merges may belong to a writer that is not done yet.
    """
    named: set[tuple[str, str]] = set()
    for kept in merge_numbers(spark, path):
        named.update((versions_at(spark, path, kept) or {}).items())
    for folder in folders:
        for name in file_names(spark, f"{path}/{folder}"):
            version = name.removeprefix("version=")
            if (name != version and (folder, version) not in named
                    and int(version.partition("-")[0]) <= number - KEPT_VERSIONS):
                delete(spark, f"{path}/{folder}/{name}")


@dataclass(frozen=True)
class KeyedTable:
    """A declared table: one partition per ``unit`` (day or year) of the column ``time``."""

    schema: StructType
    keys: list[str]
    partition: str
    time: str
    unit: str

    @property
    def partition_value(self) -> Column:
        return F.to_date(F.date_trunc(self.unit, self.time))

    @property
    def full_schema(self) -> StructType:
        return _with_partition(self.schema, self.partition)


TABLES = {
    "live_metrics": KeyedTable(
        schemas.LIVE_METRICS, schemas.WINDOW_KEYS, "window_date", "window_start", "day"),
    "daily_summary": KeyedTable(
        schemas.DAILY_SUMMARY, schemas.DAILY_KEYS, "summary_year", "summary_date", "year"),
    "anomalies": KeyedTable(
        schemas.ANOMALIES, schemas.ANOMALY_KEYS, "detected_year", "detected_date", "year"),
}


def create_tables(spark: SparkSession, root: str) -> None:
    """Create the declared tables, empty, below ``root`` where they do not exist yet."""
    for name in TABLES:
        create_exclusively(spark, f"{root}/{name}/_current/{1:012d}.json", "{}")


def merge_table(
    spark: SparkSession, root: str, name: str, updates: DataFrame, scope: DataFrame | None = None,
) -> None:
    """:func:`merge_into` for one of the declared tables."""
    table = TABLES[name]
    pin_utc(spark)  # a key has to fall into the same partition in every session
    merge_into(
        spark, f"{root}/{name}", updates, table.keys, table.schema,
        table.partition, table.partition_value, scope,
    )


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A declared table with its partition column; one never written is empty."""
    return read_versions(spark, root, name, current_versions(spark, f"{root}/{name}")[1])


def read_versions(
    spark: SparkSession, root: str, name: str, versions: dict[str, str]
) -> DataFrame:
    """The rows of some versions of a declared table's partitions."""
    return _read(spark, f"{root}/{name}", TABLES[name].full_schema, versions)
