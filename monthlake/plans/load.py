"""Initial load: records to a source partitioned by the month of their date."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from monthlake.functions import event_time, falls_in
from monthlake.months import BatchMonth
from monthlake.schema import BATCH_MONTH, INCIDENT_COLUMNS, MONTH_KEYS, REPORTED_YEAR, SOURCE_ERROR, SOURCE_SCHEMA
from monthlake.sinks.partitions import replace_partitions
from monthlake.zones import Zones

INVALID_DATE = "INVALID_DATE"

_TIME = "_event_time"


class ReconciliationError(Exception):
    """Rows went missing or appeared between two steps."""


@dataclass(frozen=True)
class LoadCounts:
    """Rows of a load, as counted while they were written."""

    total: int
    valid: int
    quarantined: int

    def check(self) -> LoadCounts:
        if self.total != self.valid + self.quarantined:
            raise ReconciliationError(f"total is not valid + quarantined: {self}")
        return self


def to_source(records: DataFrame) -> DataFrame:
    """Source rows of incident records.

    The data column ``Year`` becomes ``YearReported``; a row whose date does not parse
    goes to the sentinel month ``year=0/month=0`` and says so in ``_source_error``.
    """
    year, month = MONTH_KEYS
    dated = (
        records.select(*INCIDENT_COLUMNS)
        .withColumnRenamed("Year", REPORTED_YEAR)
        .withColumn(_TIME, event_time("Date"))
    )
    return dated.withColumns(
        {
            SOURCE_ERROR: F.when(F.col(_TIME).isNull(), F.lit(INVALID_DATE)),
            year: F.coalesce(F.year(_TIME), F.lit(0)),
            month: F.coalesce(F.month(_TIME), F.lit(0)),
        }
    ).select(*SOURCE_SCHEMA.fieldNames())


def build_source(records: DataFrame, zones: Zones, mode: str = "rebuild") -> LoadCounts:
    """Write the source in one pass over ``records`` and reconcile its counts.

    ``rebuild`` replaces the whole source; ``partitions`` replaces the months that
    occur in ``records`` and leaves the others. One shuffle brings the rows of a month
    together; the rebalance splits large months over many tasks and files.
    """
    if mode not in ("rebuild", "partitions"):
        raise ValueError(f"mode must be 'rebuild' or 'partitions', got {mode!r}")
    counts = Observation("load")
    quarantined = F.col(SOURCE_ERROR).isNotNull()
    # Counted behind the shuffle, in the tasks that write: those count once each, even
    # when tasks before the shuffle have to run again.
    source = (
        to_source(records)
        .hint("rebalance", *MONTH_KEYS)
        .observe(
            counts,
            F.count("*").alias("total"),
            F.count_if(~quarantined).alias("valid"),
            F.count_if(quarantined).alias("quarantined"),
        )
    )
    if mode == "partitions":
        replace_partitions(source, zones.source, MONTH_KEYS)
    else:
        (
            source.write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy(*MONTH_KEYS)
            .parquet(zones.source)
        )
    return LoadCounts(**counts.get).check()


def reconcile_source(source: DataFrame) -> DataFrame:
    """One row: rows of the source, of its real months and of its quarantine."""
    quarantined = F.col("year") == 0
    return source.agg(
        F.count("*").alias("total"),
        F.count_if(~quarantined).alias("valid"),
        F.count_if(quarantined).alias("quarantined"),
    )


def slice_months_raw(
    records: DataFrame, months: Iterable[BatchMonth], include_unparseable: bool = True
) -> DataFrame:
    """Records of any number of months in one pass, each with the ``batch_month`` it goes to.

    By default a record whose date does not parse goes to every one of these months.
    """
    labels = sorted({m.label for m in months})
    time = F.col(_TIME)
    everywhere = F.lit(labels) if include_unparseable else F.array().cast("array<string>")
    goes_to = F.when(time.isNull(), everywhere).otherwise(F.array(F.date_format(time, "yyyy-MM")))
    dated = records.select(*INCIDENT_COLUMNS).withColumn(_TIME, event_time("Date"))
    return dated.withColumn(BATCH_MONTH, F.explode(goes_to)).where(F.col(BATCH_MONTH).isin(labels)).drop(_TIME)


def slice_month_raw(
    records: DataFrame, month: BatchMonth, include_unparseable: bool = True
) -> DataFrame:
    """Records of one month, by default with all records whose date does not parse.

    The latter are then rejected by the rules, once per batch they are part of.
    """
    time = F.col(_TIME)
    wanted = falls_in(time, month)
    if include_unparseable:
        wanted = time.isNull() | wanted
    return records.withColumn(_TIME, event_time("Date")).where(wanted).drop(_TIME)
