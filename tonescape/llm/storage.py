"""Intermediate tables in the cluster's shared folder, removed when they are done with."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tonescape.session import shared_dir


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs run meanwhile hand at most so many rows at a time to Python, so that neither side
    holds more than that of long texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Stored:
    """``df`` written once and read back as ``frame``.

    Lineage ends here: a lost executor costs a re-read, and values that depend on the place
    of a row (row numbers) stay as they were written.
    """

    def __init__(self, df: DataFrame, label: str, group_bytes: int | None = None):
        """``group_bytes``: size of the file's row groups, which a task holds while it writes."""
        spark = df.sparkSession
        self._spark = spark
        self._path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
        writer = df.write.option("compression", "zstd")
        if group_bytes is not None:
            writer = writer.option("parquet.block.size", group_bytes)
        writer.parquet(self._path)
        self.frame = spark.read.schema(df.schema).parquet(self._path)

    def drop(self) -> None:
        """Delete the files, once nothing unstored reads them, and let go of shuffle files.

        Spark deletes the shuffle files of finished work when the driver collects the
        objects that stand for it, so a collection is asked for.
        """
        jvm = self._spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self._path)
        path.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(path, True)
        jvm.System.gc()
