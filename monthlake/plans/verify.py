"""Checks before and after a batch. Each raises or returns what it found."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthlake.months import BatchMonth
from monthlake.plans.batch import RECONCILIATION, written_counts
from monthlake.plans.catalog import CURATED_TABLE, table_partitions
from monthlake.schema import BATCH_MONTH, MONTH_KEYS
from monthlake.sources.files import read_incidents_csv
from monthlake.sources.lake import (
    content_sums,
    count_months,
    labelled_counts,
    read_curated,
    read_months,
    read_rejected,
    read_source,
    scan_months,
)
from monthlake.work import existing_children
from monthlake.zones import Zones

QUARANTINE = "0000-00"


class VerificationError(Exception):
    """A zone or the table does not hold what it should."""


def require_month(spark: SparkSession, zones: Zones, month: BatchMonth) -> DataFrame:
    """The rows of a source month; an error when it is missing or empty."""
    require_months(spark, zones, [month])
    return read_months(spark, zones, [month])


def require_months(spark: SparkSession, zones: Zones, months: Iterable[BatchMonth]) -> None:
    """An error that names the months the source does not have, or has without rows."""
    months = list(months)
    there = existing_children(spark, zones.source, 2)
    leaves = {m: zones.source_month(m) for m in months}
    missing = [leaf for leaf in leaves.values() if leaf.removeprefix(f"{zones.source}/") not in there]
    if missing:
        raise VerificationError(f"source partition missing: {', '.join(missing)}")
    found = count_months(scan_months(spark, zones, months))
    empty = [leaf for m, leaf in leaves.items() if not found.get(m)]
    if empty:
        raise VerificationError(f"source partition empty: {', '.join(empty)}")


def verify_source(spark: SparkSession, zones: Zones) -> DataFrame:
    """Rows per month of the source, its quarantine (``0``, ``0``) as a line of its own."""
    found = read_source(spark, zones).groupBy(*MONTH_KEYS).agg(F.count("*").alias("rows"))
    lines = found.orderBy(*MONTH_KEYS).collect()  # one per month
    if not any(line["year"] > 0 for line in lines):
        raise VerificationError(f"no month in the source: {zones.source}")
    return spark.createDataFrame(lines, found.schema)


def verify_month(
    spark: SparkSession, zones: Zones, month: BatchMonth, table: str = CURATED_TABLE
) -> DataFrame:
    """Check one processed month: written, reconciled, and visible in SQL.

    The partition has to match exactly (month 1 is not month 10). A month without any
    rejected row is fine; one without any valid row needs no partition.
    """
    raw = count_months(scan_months(spark, zones, [month])).get(month, 0)
    try:
        curated, rejected = written_counts(spark, zones, [month])[month]
    except AnalysisException as error:
        raise VerificationError(f"results of {month.label} are missing") from error
    if curated and table_partitions(spark, table).where(month.predicate()).isEmpty():
        raise VerificationError(f"{table} does not show partition {month.partition}")
    visible = spark.table(table).where(month.predicate()).count()
    if raw != curated + rejected or visible != curated:
        raise VerificationError(
            f"{month.label}: {raw} source rows, {curated} curated, {rejected} rejected, "
            f"{visible} visible in {table}"
        )
    return spark.createDataFrame(
        [(month.label, raw, curated, rejected, visible)],
        "batch_month string, raw bigint, curated bigint, rejected bigint, visible bigint",
    )


def verify_raw_month(spark: SparkSession, zones: Zones, month: BatchMonth) -> DataFrame:
    """Check a month that was processed from its CSV slice: there, written, reconciled."""
    try:
        raw = read_incidents_csv(spark, zones.raw_month(month)).count()
        curated, rejected = written_counts(spark, zones, [month])[month]
    except AnalysisException as error:
        raise VerificationError(f"slice or results of {month.label} are missing") from error
    if raw == 0 or raw != curated + rejected:
        raise VerificationError(
            f"{month.label}: {raw} raw rows, {curated} curated, {rejected} rejected"
        )
    return spark.createDataFrame([(month.label, raw, curated, rejected)], RECONCILIATION)


def verify_lake(spark: SparkSession, zones: Zones, table: str = CURATED_TABLE) -> DataFrame:
    """The counts of `verify_month` for every month of the lake, in one query.

    Quarantined source rows belong to no batch and form the line ``0000-00``, which
    must have no results.
    """

    zone_rows = (
        labelled_counts(read_source(spark, zones), "raw")
        .unionByName(labelled_counts(read_curated(spark, zones), "curated"))
        .unionByName(labelled_counts(read_rejected(spark, zones), "rejected"))
        .unionByName(labelled_counts(spark.table(table), "visible"))
    )
    counts = zone_rows.groupBy(BATCH_MONTH).agg(
        *[
            F.sum(F.when(F.col("zone") == zone, F.col("rows")).otherwise(0)).alias(zone)
            for zone in ("raw", "curated", "rejected", "visible")
        ]
    )
    due = F.when(F.col(BATCH_MONTH) == QUARANTINE, F.lit(0)).otherwise(F.col("raw"))
    sound = (due == F.col("curated") + F.col("rejected")) & (F.col("visible") == F.col("curated"))
    return counts.withColumn("sound", sound).orderBy(BATCH_MONTH)


def verify_content(spark: SparkSession, zones: Zones, table: str = CURATED_TABLE) -> DataFrame:
    """Whether every month's curated and rejected rows are the rows of its source, not just as many.

    Compares sums of row hashes, so rows that were swapped between months are found, which
    counts do not see. Reads all columns of all zones once. The quarantine must have no results.
    """
    zone_sums = (
        content_sums(read_source(spark, zones), "raw")
        .unionByName(content_sums(read_curated(spark, zones), "curated"))
        .unionByName(content_sums(read_rejected(spark, zones), "rejected"))
        .unionByName(content_sums(spark.table(table), "visible"))
    )

    def of(zone: str, column: str) -> Column:
        return F.sum(F.when(F.col("zone") == zone, F.col(column)).otherwise(0))

    sums = zone_sums.groupBy(BATCH_MONTH).agg(
        *(of(zone, column).alias(f"{zone}_{column}") for zone in ("raw", "curated", "rejected", "visible") for column in ("rows", "content"))
    )
    quarantine = F.col(BATCH_MONTH) == QUARANTINE
    sound = F.lit(True)
    for column in ("rows", "content"):
        due = F.when(quarantine, F.lit(0)).otherwise(F.col(f"raw_{column}"))
        sound = sound & (due == F.col(f"curated_{column}") + F.col(f"rejected_{column}"))
        sound = sound & (F.col(f"visible_{column}") == F.col(f"curated_{column}"))
    return sums.select(BATCH_MONTH, F.col("raw_rows").alias("raw"), sound.alias("sound")).orderBy(BATCH_MONTH)


def require_sound(lines: DataFrame) -> DataFrame:
    """The lines of `verify_lake` or `verify_content`, one per month; an error that names the unsound ones."""
    rows = lines.collect()
    wrong = [row[BATCH_MONTH] for row in rows if not row["sound"]]
    if wrong:
        raise VerificationError(f"not sound: {', '.join(wrong)}")
    return lines.sparkSession.createDataFrame(rows, lines.schema)


def pruned_partitions(spark: SparkSession, zones: Zones, month: BatchMonth) -> DataFrame:
    """The partitions whose files a month filter over the whole source really reads."""
    pruned = read_source(spark, zones).where(month.predicate())
    place = F.regexp_extract("_metadata.file_path", r"year=(\d+)/month=(\d+)/", 1), F.regexp_extract(
        "_metadata.file_path", r"year=(\d+)/month=(\d+)/", 2
    )
    files = pruned.select(*(p.cast("int").alias(k) for p, k in zip(place, MONTH_KEYS)))
    return files.groupBy(*MONTH_KEYS).agg(F.count("*").alias("rows"))


def explain_month(spark: SparkSession, zones: Zones, month: BatchMonth) -> DataFrame:
    """The physical plan of a month filter over the whole source, one row per line.

    Its ``PartitionFilters`` show that no other month is read.
    """
    pruned = read_source(spark, zones).where(month.predicate())
    text = pruned._jdf.queryExecution().executedPlan().toString()
    return spark.createDataFrame(list(enumerate(text.splitlines())), "line int, plan string")
