"""Written intermediate tables in the folder that all executors share."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession

from ordermetrics.session import fresh_dir, settings

# A table is written once, so its shuffles are of no use once it is there. Batches of texts stay
# small on both sides of a Python worker.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
           "spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}


class Scratch:
    """Tables of one run of an operator; ``drop`` removes those that are no longer read.

    The folder lies below ``spark.checkpoint.dir``. Tables that a returned frame still reads
    have to stay; they go with that folder.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = fresh_dir(spark, label)

    def keep(self, frame: DataFrame, name: str) -> DataFrame:
        """Write ``frame`` and read it back; cuts its lineage."""
        path = f"{self.root}/{name}"
        with settings(self.spark, WRITING):
            frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def release(self) -> None:
        """Let Spark delete the shuffle files of finished jobs that wrote other tables.

        It does so once the driver's garbage is collected, which else may be half an hour
        later, while the disks of all executors fill.
        """
        gc.collect()
        self.spark._jvm.System.gc()
