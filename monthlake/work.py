"""Folders for intermediate data."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    Only a local session that names none gets a folder of its own; on a cluster a
    missing setting is an error, since executors cannot see each other's disks.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="monthlake-")
    spark.conf.set(CHECKPOINT_DIR, local)
    return local


def _on_storage(spark: SparkSession, path: str):
    """The file system of a path, and the path as that file system takes it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    storage, hadoop_path = _on_storage(spark, path)
    return storage.exists(hadoop_path)


def existing_children(spark: SparkSession, path: str, levels: int) -> set[str]:
    """Folders this many levels below a path, relative to it; none if it is not there."""
    storage, hadoop_path = _on_storage(spark, path)
    if not storage.exists(hadoop_path):
        return set()
    pattern = spark._jvm.org.apache.hadoop.fs.Path(path + "/*" * levels)
    found = storage.globStatus(pattern) or []
    return {"/".join(str(status.getPath()).rsplit("/", levels)[1:]) for status in found}


def replace_folder(spark: SparkSession, source: str, target: str) -> None:
    """The files of one folder as the whole content of another."""
    storage, source_path = _on_storage(spark, source)
    target_storage, target_path = _on_storage(spark, target)
    target_storage.delete(target_path, True)
    target_storage.mkdirs(target_path.getParent())
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(
        storage, source_path, target_storage, target_path, False, spark._jsc.hadoopConfiguration()
    )


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Puts a folder in the place of another of the same storage; an empty one if it is not there."""
    storage, source_path = _on_storage(spark, source)
    target_path = spark._jvm.org.apache.hadoop.fs.Path(target)
    storage.delete(target_path, True)
    if not storage.exists(source_path):
        storage.mkdirs(target_path)
        return
    storage.mkdirs(target_path.getParent())
    if not storage.rename(source_path, target_path):
        raise OSError(f"{source} could not be moved to {target}")


def join_files(spark: SparkSession, folders: Sequence[str], target: str) -> None:
    """The files of folders, by folder and name, as one file.

    Bytes go from one stream to the other; nothing is held but a small buffer.
    """
    storage, target_path = _on_storage(spark, target)
    hadoop = spark._jvm.org.apache.hadoop
    unfinished = hadoop.fs.Path(target_path.getParent(), f"_{target_path.getName()}")
    out = storage.create(unfinished, True)
    try:
        for folder in folders:
            source, path = _on_storage(spark, folder)
            parts = [s.getPath() for s in source.listStatus(path) if s.isFile() and s.getPath().getName().startswith("part-")]
            for part in sorted(parts, key=lambda p: p.getName()):
                piece = source.open(part)
                try:
                    hadoop.io.IOUtils.copyBytes(piece, out, 1 << 16, False)
                finally:
                    piece.close()
    finally:
        out.close()
    if not storage.rename(unfinished, target_path):
        raise OSError(f"{target} could not be written")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder, removed when the session's JVM ends."""
    path = f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"
    storage, hadoop_path = _on_storage(spark, path)
    storage.mkdirs(hadoop_path)
    storage.deleteOnExit(hadoop_path)
    return path


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder of ``new_folder`` with all that lies in it."""
    storage, hadoop_path = _on_storage(spark, path)
    storage.delete(hadoop_path, True)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows of a frame as a table in the shared folder.

    Cuts the lineage: readers take what was written, whatever happens to executors. The
    table stays until the session's JVM ends; ``borrowed`` gives it up earlier.
    """
    path = f"{new_folder(df.sparkSession, purpose)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def borrowed(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """Like ``stored``, for the time of a block; the table goes with it, also on errors."""
    spark = df.sparkSession
    folder = new_folder(spark, purpose)
    try:
        df.write.parquet(f"{folder}/table")
        yield spark.read.schema(df.schema).parquet(f"{folder}/table")
    finally:
        remove_folder(spark, folder)
