"""The raw zone: months of the landing file as CSV."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame

from monthlake.months import BatchMonth
from monthlake.schema import BATCH_MONTH, INCIDENT_COLUMNS
from monthlake.work import move_folder, remove_folder
from monthlake.zones import Zones

# Slices hold every undated record once per month, so they are written compressed.
COMPRESSION = "gzip"


def write_raw_month(rows: DataFrame, zones: Zones, month: BatchMonth) -> None:
    rows.select(*INCIDENT_COLUMNS).write.mode("overwrite").option("header", True).option(
        "compression", COMPRESSION
    ).csv(zones.raw_month(month))


def write_raw_months(rows: DataFrame, zones: Zones, months: Iterable[BatchMonth]) -> None:
    """Replaces the slices of these months in one pass over ``rows`` (with ``batch_month``).

    Rows are brought together by month, a large month in several tasks and files. The new
    slices are written beside the old ones and moved into place month by month; a month
    without rows gets an empty folder.
    """
    spark = rows.sparkSession
    beside = f"{zones.raw}/_{uuid.uuid4().hex}"
    try:
        (
            rows.select(*INCIDENT_COLUMNS, BATCH_MONTH)
            .hint("rebalance", BATCH_MONTH)
            .write.partitionBy(BATCH_MONTH)
            .option("header", True)
            .option("compression", COMPRESSION)
            .csv(beside)
        )
        for month in sorted(set(months)):
            move_folder(spark, f"{beside}/{BATCH_MONTH}={month.label}", zones.raw_month(month))
    finally:
        remove_folder(spark, beside)
