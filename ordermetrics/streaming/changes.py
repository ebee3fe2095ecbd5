"""Changed (window, sku) totals of every micro-batch, kept as files.

Layout: ``<root>/slot=<hour or day of the window>/batch_id=<n>``. A batch writes its own
folders and rewrites exactly those when it is replayed. The current total of a key is
its row with the highest batch id, because totals are cumulative. Reading one slot
opens only that slot's folders. A live stream, whose batches touch a few minutes, keeps
one slot per hour; a backfill over months keeps one per day. The choice belongs to the
target and stays the same for its life.

Folders of a slot are folded while it is open: ``FAN`` of committed batches become one run,
``FAN`` runs of one level become one of the next, each with the last total of every key. So
a batch opens a number of folders that grows with the logarithm of the batches before it,
and a row is written again as often. Runs lie in ``<root>__runs/slot=<...>/run=<name>``. A
small file for each slot, created exclusively, lists those that are live and up to which
batch they reach. Rows carry their batch id wherever they lie, so a row that is read twice
does no harm, and a fold that crashed or was beaten by another one is simply not listed.
What a fold replaces stays until the fold after it, for queries that are reading it.
"""

from __future__ import annotations

import json
import logging
import uuid
from datetime import datetime, timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermetrics.operators.merge import latest_per_key, latest_with_version
from ordermetrics.schemas import WINDOW_KEYS, WINDOW_SKU
from ordermetrics.session import PRUNABLE_TIMES, settings
from ordermetrics.sinks.files import (
    create_exclusively, delete, exists, file_names, folder_names, text_of,
)

SCHEMA = T.StructType([
    *WINDOW_SKU.fields,
    T.StructField("slot", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])
RUN_SCHEMA = T.StructType([
    *WINDOW_SKU.fields,
    T.StructField("batch_id", T.LongType()),
    T.StructField("slot", T.StringType()),
    T.StructField("run", T.StringType()),
])
log = logging.getLogger("ordermetrics")

# Folders of one level that become one of the next.
FAN = 8
SKU_KEYS = [*WINDOW_KEYS, "sku"]
ROWS_PER_FILE = 500_000
SLOT_FORMATS = {"hour": "yyyy-MM-dd-HH", "day": "yyyy-MM-dd"}
SLOT_SECONDS = {"hour": 3600, "day": 86400}
# A batch whose range covers more slots is found by a filter on the whole table.
LISTED_SLOTS = 1000
EPOCH = datetime(1970, 1, 1)


def _write(rows: DataFrame, root: str) -> None:
    with settings(rows.sparkSession, PRUNABLE_TIMES):
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "slot", "batch_id").parquet(root)


class Touched(NamedTuple):
    """What a micro-batch changed: number of keys and range of their window starts."""

    keys: int
    first_micros: int | None
    last_micros: int | None
    slot: str

    def slot_names(self) -> list[str] | None:
        """Every slot of the range, or None when they are too many to list."""
        length = SLOT_SECONDS[self.slot]
        first, last = (micros // 1_000_000 // length for micros in (self.first_micros, self.last_micros))
        if last - first >= LISTED_SLOTS:
            return None
        pattern = "%Y-%m-%d-%H" if self.slot == "hour" else "%Y-%m-%d"
        starts = (EPOCH + timedelta(seconds=n * length) for n in range(first, last + 1))
        return [start.strftime(pattern) for start in starts]


def write_changes(batch: DataFrame, batch_id: int, root: str, slot: str = "hour") -> Touched:
    """Store a micro-batch and return what it touched.

    Rows are range-partitioned by slot and SKU: files come out at about
    ``ROWS_PER_FILE`` rows, a backfill over many slots does not multiply them by the
    number of state partitions, and a busy slot is spread over many tasks. The batch is
    persisted because sizing and sampling would otherwise run the stateful stage again.
    """
    rows = batch.withColumns({
        "slot": F.date_format("window_start", SLOT_FORMATS[slot]),
        "batch_id": F.lit(batch_id).cast("long"),
    }).persist()
    try:
        start = F.unix_micros("window_start")
        touched = Touched(*rows.agg(F.count("*"), F.min(start), F.max(start)).first(), slot)
        if touched.keys:
            files = -(-touched.keys // ROWS_PER_FILE)
            _write(rows.repartitionByRange(files, "slot", "sku"), root)
    finally:
        rows.unpersist()
    log.info("batch %s: %s keys changed", batch_id, touched.keys)
    return touched


def read_changes(spark: SparkSession, root: str, slots: list[str] | None = None) -> DataFrame:
    """All stored changes, or those of some slots, without listing the others."""
    runs = f"{root}__runs"
    if slots is None:
        paths, folded = [root], [runs] if exists(spark, runs) else []
    else:
        paths, folded = [], []
        for slot in slots:
            live = live_runs(spark, root, slot)
            paths += [f"{root}/slot={slot}/batch_id={n}"
                      for n in _batches(spark, root, slot) if n > live.upto]
            folded += [f"{runs}/slot={slot}/run={name}" for name in live.runs]
    rows = spark.createDataFrame([], SCHEMA)
    if paths:
        rows = spark.read.schema(SCHEMA).option("basePath", root).parquet(*paths)
    if folded:
        older = spark.read.schema(RUN_SCHEMA).option("basePath", runs).parquet(*folded)
        rows = rows.unionByName(older.drop("run"))
    return rows


class LiveRuns(NamedTuple):
    """The runs of a slot by level, the last batch they hold, and what the last fold replaced."""

    number: int = 0
    upto: int = -1
    runs: dict[str, int] = {}
    replaced: list[str] = []


def _lists(root: str, slot: str) -> str:
    return f"{root}__runs/_live/slot={slot}"


def live_runs(spark: SparkSession, root: str, slot: str) -> LiveRuns:
    """What is listed for a slot; nothing where it was never folded."""
    folder = _lists(root, slot)
    for name in sorted((n for n in file_names(spark, folder) if n.endswith(".json")), reverse=True):
        text = text_of(spark, f"{folder}/{name}")
        if text.endswith("}"):  # else its writer has not finished it
            return LiveRuns(int(name.removesuffix(".json")), **json.loads(text))
    return LiveRuns()


def fold_slot(
    spark: SparkSession, root: str, slot: str, committed: int, fan: int | None = FAN,
) -> bool:
    """Fold what is due in a slot; with ``fan=None`` all of it into one run.

    Only batches up to ``committed`` take part: a later one may be replayed and overwrites
    its own folder. Levels that are full go into the same run, so a fold reads and writes
    once. False if nothing was due, or another writer folded the slot meanwhile.
    """
    live = live_runs(spark, root, slot)
    fresh = sorted(n for n in _batches(spark, root, slot) if live.upto < n <= committed)
    level, taken = 1, []
    if fan is None:
        taken = list(live.runs)
        if len(fresh) + len(taken) < 2:
            return False
        level = max(live.runs.values(), default=0) + 1
    else:
        if len(fresh) < fan:
            return False
        while len(full := [name for name, at in live.runs.items() if at == level]) + 1 >= fan:
            taken += full
            level += 1
    for folder in live.replaced:
        delete(spark, folder)
    folders = [f"{root}/slot={slot}/batch_id={n}" for n in fresh]
    older = [f"{root}__runs/slot={slot}/run={name}" for name in taken]
    rows = spark.createDataFrame([], SCHEMA)
    if folders:
        rows = spark.read.schema(SCHEMA).option("basePath", root).parquet(*folders)
    if older:
        rows = rows.unionByName(spark.read.schema(RUN_SCHEMA).option(
            "basePath", f"{root}__runs").parquet(*older).drop("run"))
    upto = max([live.upto, *fresh])
    name = f"{upto}-{uuid.uuid4().hex[:12]}"
    path = f"{root}__runs/slot={slot}/run={name}"
    with settings(spark, PRUNABLE_TIMES):
        latest_with_version(rows.drop("slot"), SKU_KEYS, "batch_id").hint(
            "rebalance").sortWithinPartitions("window_start").write.parquet(path)
    runs = {n: at for n, at in live.runs.items() if n not in taken} | {name: level}
    listed = {"upto": upto, "runs": runs, "replaced": folders + older}
    if not create_exclusively(
            spark, f"{_lists(root, slot)}/{live.number + 1:09d}.json", json.dumps(listed)):
        delete(spark, path)
        return False
    if live.number > 1:
        delete(spark, f"{_lists(root, slot)}/{live.number - 1:09d}.json")
    log.info("slot %s: %s folders folded into a run of level %s", slot, len(folders) + len(older), level)
    return True


def touched_windows(
    spark: SparkSession, root: str, touched: Touched, batch_id: int
) -> DataFrame:
    """Stored changes, of any batch, to the windows that batch ``batch_id`` changed.

    The range of window starts lets parquet skip the rest of a slot by its statistics.
    """
    first, last = (
        F.timestamp_micros(F.lit(micros)) for micros in (touched.first_micros, touched.last_micros)
    )
    start, name = F.col("window_start"), SLOT_FORMATS[touched.slot]
    near = (
        read_changes(spark, root, touched.slot_names())
        .filter(F.col("slot").between(F.date_format(first, name), F.date_format(last, name)))
        .filter((start >= first) & (start <= last))
    )
    windows = near.filter(F.col("batch_id") == batch_id).select(*WINDOW_KEYS).distinct()
    return near.join(windows, WINDOW_KEYS, "left_semi")


def current_totals(changes: DataFrame) -> DataFrame:
    """(window, sku) totals as of the last stored batch."""
    return latest_per_key(changes.drop("slot"), SKU_KEYS, "batch_id")


def _batches(spark: SparkSession, root: str, slot: str) -> list[int]:
    names = folder_names(spark, f"{root}/slot={slot}")
    return [int(name.removeprefix("batch_id=")) for name in names]


def last_committed(spark: SparkSession, checkpoint: str) -> int:
    """The last batch a stream has committed, and so will not run again; -1 before the first."""
    return max((int(n) for n in file_names(spark, f"{checkpoint}/commits") if n.isdigit()), default=-1)


def slots_before(spark: SparkSession, root: str, before: str, committed: int) -> list[str]:
    """Stored slots that end by ``before`` (an hour or a day) and hold several committed folders."""
    names = [name.removeprefix("slot=") for name in folder_names(spark, root)]
    found = []
    for slot in sorted(name for name in names if name < before[:len(name)]):
        live = live_runs(spark, root, slot)
        fresh = [n for n in _batches(spark, root, slot) if live.upto < n <= committed]
        if len(fresh) + len(live.runs) > 1:
            found.append(slot)
    return found


def compact_slots(spark: SparkSession, root: str, slots: list[str], committed: int) -> None:
    """Keep one run of committed batches per slot, for slots the watermark has closed.

    Nothing that a reader may hold is overwritten: what the run replaces goes with the slot's
    next fold or with :func:`remove_replaced`. A batch after ``committed`` may be replayed and
    would then overwrite its folder, so its folder is left as it is.
    """
    for slot in slots:
        fold_slot(spark, root, slot, committed, fan=None)


def remove_replaced(spark: SparkSession, root: str, before: str) -> None:
    """Delete what earlier folds of the slots that end by ``before`` have replaced."""
    names = [name.removeprefix("slot=") for name in folder_names(spark, f"{root}__runs")]
    for slot in names:
        if slot < before[:len(slot)]:
            for folder in live_runs(spark, root, slot).replaced:
                delete(spark, folder)
