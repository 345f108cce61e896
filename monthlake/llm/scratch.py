"""Tables of intermediate rows in the shared folder, each dropped after its last reader."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from monthlake.work import new_folder, remove_folder


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_TWO_MAPS = "spark.sql.codegen.aggregate.map.twolevel.enabled"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_cleaned(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs in here go as it ends: its result is a table."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Tasks get this many rows at once from jobs that run in here; for long texts and large models."""
    before = spark.conf.get(_BATCH, None)
    spark.conf.set(_BATCH, str(rows))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH)
        else:
            spark.conf.set(_BATCH, before)


@contextmanager
def one_map(spark: SparkSession) -> Iterator[None]:
    """Aggregations of jobs that run in here keep one hash map; with dozens of columns the second costs more than it saves."""
    before = spark.conf.get(_TWO_MAPS, None)
    spark.conf.set(_TWO_MAPS, "false")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_TWO_MAPS)
        else:
            spark.conf.set(_TWO_MAPS, before)


class Scratch:
    """Writes frames as tables; ``drop`` takes what ``put`` gave.

    What is not dropped goes when the session's JVM ends: a result that is read lazily
    may still need it.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._folders: dict[int, tuple[DataFrame, str]] = {}

    def put(self, df: DataFrame, purpose: str, codec: str = "zstd") -> DataFrame:
        folder = new_folder(self.spark, purpose)
        with _shuffles_cleaned(self.spark):
            df.write.option("compression", codec).parquet(f"{folder}/table")
        table = self.spark.read.schema(df.schema).parquet(f"{folder}/table")
        self._folders[id(table)] = (table, folder)
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            _, folder = self._folders.pop(id(table))
            remove_folder(self.spark, folder)
