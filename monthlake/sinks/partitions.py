"""Writes that replace exactly the months they are given."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthlake.months import BatchMonth, month_label
from monthlake.schema import (
    BATCH_KEYS,
    BATCH_MONTH,
    CURATED_COLUMNS,
    MONTH_KEYS,
    REJECTED_COLUMNS,
)
from monthlake.work import existing_children, new_folder, remove_folder, replace_folder
from monthlake.zones import Zones


def replace_partitions(df: DataFrame, path: str, keys: list[str]) -> None:
    """Overwrite the partitions that occur in ``df`` and no other.

    The mode is set on the write, so the session's setting does not matter.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def empty_partitions(columns: DataFrame, leaves: Iterable[str]) -> None:
    """Leave partition directories that hold no rows, but the columns of a frame.

    One empty file is written and copied, so many partitions cost one job.
    """
    leaves = list(leaves)
    if not leaves:
        return
    spark = columns.sparkSession
    pattern = new_folder(spark, "empty")
    try:
        columns.limit(0).write.mode("overwrite").parquet(f"{pattern}/leaf")
        for leaf in leaves:
            replace_folder(spark, f"{pattern}/leaf", leaf)
    finally:
        remove_folder(spark, pattern)


def write_curated(valid: DataFrame, zones: Zones) -> None:
    """Write valid rows to their months."""
    keys = [F.col(b).alias(m) for b, m in zip(BATCH_KEYS, MONTH_KEYS)]
    replace_partitions(valid.select(*CURATED_COLUMNS, *keys), zones.curated, MONTH_KEYS)


def write_rejected(rejected: DataFrame, zones: Zones, in_place: Column | None = None) -> None:
    """Write rejected rows with their reasons to the directory of their batch.

    The few rejected rows of each task are brought together, for files of a fair size;
    large batches are still split over many tasks. Rows that are ``in_place`` already lie
    together by month and are written by the tasks that read them.
    """
    label = month_label(*BATCH_KEYS).alias(BATCH_MONTH)
    rows = rejected.select(*REJECTED_COLUMNS, label)
    if in_place is None:
        rows = rows.hint("rebalance", BATCH_MONTH)
    else:
        rows = rows.where(in_place).unionByName(rows.where(~in_place).hint("rebalance", BATCH_MONTH))
    replace_partitions(rows, zones.rejected, [BATCH_MONTH])


def clear_curated(like: DataFrame, zones: Zones, months: Iterable[BatchMonth]) -> None:
    """Empty the months of a batch that have no valid row, but have one from before.

    The overwrite of the partitions that occur leaves the rows of an earlier run there.
    """
    there = existing_children(like.sparkSession, zones.curated, 2)
    leaves = [zones.curated_month(m) for m in months]
    old = [leaf for leaf in leaves if leaf.removeprefix(f"{zones.curated}/") in there]
    empty_partitions(like.select(*CURATED_COLUMNS), old)


def clear_rejected(like: DataFrame, zones: Zones, months: Iterable[BatchMonth]) -> None:
    """The same for months without a rejected row; their directory is always there."""
    empty_partitions(like.select(*REJECTED_COLUMNS), [zones.rejected_month(m) for m in months])
