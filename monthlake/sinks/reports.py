"""Reports as CSV, and on the console."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from monthlake.work import join_files, new_folder, remove_folder


def write_report_csv(
    df: DataFrame, path: str, *, single_file: bool = False, order: Sequence[Column | str] = ()
) -> int:
    """Write a report with a header line, replacing an earlier one; returns its rows.

    The files follow ``order`` by name, or keep the report's own order; ranges of the order
    are sorted in tasks of their own. With ``single_file`` the parts of many tasks are then
    joined to one file behind one header line, as bytes: no task holds all rows.
    """
    spark, seen = df.sparkSession, Observation("report")
    # Counted behind the sort: what is before it runs once more to find the ranges.
    report = (df.orderBy(*order) if order else df).observe(seen, F.count("*").alias("rows"))
    if not single_file:
        report.write.mode("overwrite").option("header", True).csv(path)
        return seen.get["rows"]
    folder = new_folder(spark, "report")
    try:
        spark.createDataFrame([], df.schema).write.option("header", True).csv(f"{folder}/header")
        report.write.option("header", False).csv(f"{folder}/parts")
        remove_folder(spark, path)
        join_files(spark, [f"{folder}/header", f"{folder}/parts"], f"{path}/part-00000.csv")
    finally:
        remove_folder(spark, folder)
    return seen.get["rows"]


def print_rows(df: DataFrame, rows: int | None = None) -> int:
    """Print a header and every row, tab-separated; only the first ``rows`` if asked for.

    Rows come partition by partition, so the driver never holds them all.
    """
    print("\t".join(df.columns))
    printed = 0
    for row in (df if rows is None else df.limit(rows)).toLocalIterator(prefetchPartitions=True):
        print("\t".join("null" if value is None else str(value) for value in row))
        printed += 1
    return printed
