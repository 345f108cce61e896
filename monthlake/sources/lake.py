"""Scans of the partitioned zones.

Every scan passes its schema: no footer is read to infer one, and a partition
written with other columns cannot change what a reader sees.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthlake.months import BatchMonth, month_label
from monthlake.operators.row_id import with_row_id
from monthlake.schema import (
    BATCH_KEYS,
    BATCH_MONTH,
    CURATED_SCHEMA,
    INCIDENT_COLUMNS,
    MONTH_KEYS,
    REJECTED_SCHEMA,
    REPORTED_YEAR,
    SOURCE_ERROR,
    SOURCE_SCHEMA,
)
from monthlake.zones import Zones


def read_source(spark: SparkSession, zones: Zones) -> DataFrame:
    """The whole source, with its quarantine partition ``year=0/month=0``."""
    return spark.read.schema(SOURCE_SCHEMA).parquet(zones.source)


def read_curated(spark: SparkSession, zones: Zones) -> DataFrame:
    return spark.read.schema(CURATED_SCHEMA).parquet(zones.curated)


def read_rejected(spark: SparkSession, zones: Zones) -> DataFrame:
    return spark.read.schema(REJECTED_SCHEMA).parquet(zones.rejected)


def scan_months(spark: SparkSession, zones: Zones, months: Iterable[BatchMonth]) -> DataFrame:
    """Exactly the partitions of the given months, as stored.

    Only their directories are listed, not the whole tree; a month without one is an
    error.
    """
    leaves = [zones.source_month(m) for m in months]
    return spark.read.schema(SOURCE_SCHEMA).option("basePath", zones.source).parquet(*leaves)


def as_records(scan: DataFrame) -> DataFrame:
    """Incident records of a scan of the source, with batch keys and a row identity."""
    stored = [REPORTED_YEAR if c == "Year" else c for c in INCIDENT_COLUMNS]
    # The batch keys take their names before Year gets its own back: Year and year are
    # one name to Spark.
    return (
        with_row_id(scan, stored)
        .drop(SOURCE_ERROR)
        .withColumnsRenamed(dict(zip(MONTH_KEYS, BATCH_KEYS)))
        .withColumnRenamed(REPORTED_YEAR, "Year")
    )


def read_months(spark: SparkSession, zones: Zones, months: Iterable[BatchMonth]) -> DataFrame:
    """The incident records of the given months."""
    return as_records(scan_months(spark, zones, months))


def read_month(spark: SparkSession, zones: Zones, month: BatchMonth) -> DataFrame:
    """One month as the 22 incident columns."""
    return read_months(spark, zones, [month]).select(*INCIDENT_COLUMNS)


def count_months(df: DataFrame, keys: Sequence[str] = MONTH_KEYS) -> dict[BatchMonth, int]:
    """Rows per month of a frame, one entry per month.

    On a scan of a partitioned zone this reads no column, only footers.
    """
    rows = df.groupBy(*keys).agg(F.count("*").alias("rows")).collect()
    return {BatchMonth(*(row[k] for k in keys)): row["rows"] for row in rows}


def content_sums(df: DataFrame, zone: str) -> DataFrame:
    """Like `labelled_counts`, with the sum of the rows' hashes as ``content``.

    The sum does not depend on order or layout and adds up over zones. It covers the
    columns that all zones have (all but the reported year).
    """
    keys = [BATCH_MONTH] if BATCH_MONTH in df.columns else MONTH_KEYS
    label = F.col(BATCH_MONTH) if BATCH_MONTH in df.columns else month_label(*MONTH_KEYS)
    row = F.xxhash64(*(F.col(c) for c in INCIDENT_COLUMNS if c != "Year"))
    sums = df.groupBy(*keys).agg(F.count("*").alias("rows"), F.sum(row.cast("decimal(20,0)")).alias("content"))
    return sums.select(label.alias(BATCH_MONTH), F.lit(zone).alias("zone"), "rows", "content")


def labelled_counts(df: DataFrame, zone: str) -> DataFrame:
    """Rows per ``batch_month`` of one zone, whose name stands in ``zone``.

    Counted by the partition columns as they are, and labelled after that.
    """
    keys = [BATCH_MONTH] if BATCH_MONTH in df.columns else MONTH_KEYS
    label = F.col(BATCH_MONTH) if BATCH_MONTH in df.columns else month_label(*MONTH_KEYS)
    counts = df.groupBy(*keys).agg(F.count("*").alias("rows"))
    return counts.select(label.alias(BATCH_MONTH), F.lit(zone).alias("zone"), "rows")
