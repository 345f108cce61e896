"""Monthly batches: check, deduplicate, write, reconcile."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from monthlake.months import BatchMonth
from monthlake.operators.dedupe import DUPLICATE_REASON, TEXT_ORDER, first_rows, mark_duplicates, settle_ties
from monthlake.operators.layout import ROWS_PER_TASK, MonthLayout
from monthlake.operators.row_id import ROW_ID, place_only, with_row_id
from monthlake.operators.rules import RuleGroup, classify, is_valid
from monthlake.plans.load import ReconciliationError
from monthlake.schema import (
    BATCH_KEYS,
    BATCH_MONTH,
    CURATED_SCHEMA,
    INCIDENT_COLUMNS,
    REJECTED_SCHEMA,
    REJECT_REASON,
)
from monthlake.sinks.partitions import (
    clear_curated,
    clear_rejected,
    write_curated,
    write_rejected,
)
from monthlake.sources.files import read_incidents_csv
from monthlake.sources.lake import as_records, count_months, labelled_counts, scan_months
from monthlake.work import borrowed, existing_children
from monthlake.zones import Zones

RECONCILIATION = "batch_month string, raw bigint, curated bigint, rejected bigint"


def reconcile(classified: DataFrame, keys: Sequence[str] = BATCH_KEYS) -> DataFrame:
    """Rows, valid rows and rejected rows per batch, with whether they add up."""
    return (
        classified.groupBy(*keys)
        .agg(
            F.count("*").alias("raw"),
            F.count_if(is_valid()).alias("curated"),
            F.count_if(~is_valid()).alias("rejected"),
        )
        .withColumn("balanced", F.col("raw") == F.col("curated") + F.col("rejected"))
    )


def process_months(
    spark: SparkSession, zones: Zones, months: Iterable[BatchMonth], **settings
) -> DataFrame:
    """Process months of the source, any number of them in one job.

    Reads only their partitions and replaces only their results. Returns the
    reconciliation; ``settings`` are those of `process_batch`.
    """
    batch = sorted(set(months))
    scan = scan_months(spark, zones, batch)  # lists the files once, for count and batch
    found = count_months(scan)
    raw = {month: found.get(month, 0) for month in batch}
    return process_batch(as_records(scan), zones, raw, **settings)


def process_raw_month(
    spark: SparkSession, zones: Zones, month: BatchMonth, **settings
) -> DataFrame:
    """Process one month from its CSV slice in the raw zone.

    All rows of the slice belong to the batch, so undated ones are rejected with it.
    The text is parsed once; what follows reads columns.
    """
    year, month_number = BATCH_KEYS
    with borrowed(read_incidents_csv(spark, zones.raw_month(month)), "raw") as scan:
        rows = with_row_id(scan, INCIDENT_COLUMNS).withColumns(
            {year: F.lit(month.year), month_number: F.lit(month.month)}
        )
        return process_batch(rows, zones, {month: scan.count()}, **settings)


def process_raw_months(
    spark: SparkSession, zones: Zones, months: Iterable[BatchMonth], **settings
) -> DataFrame:
    """Process any number of months from their CSV slices, in one job.

    A slice is one batch, so an undated row is rejected once in each slice that holds it. These
    are most rows of many slices; they are neither joined nor shuffled, as slices lie by month.
    """
    batch = sorted(set(months))
    keys = [F.regexp_extract("_metadata.file_path", r"/(\d{4})-(\d{2})/[^/]*$", i).cast("int") for i in (1, 2)]
    slices = read_incidents_csv(spark, [zones.raw_month(m) for m in batch])
    slices = slices.withColumns(dict(zip(BATCH_KEYS, keys)))
    with borrowed(slices, "raw") as scan:
        found = count_months(scan, BATCH_KEYS)
        raw = {month: found.get(month, 0) for month in batch}
        return process_batch(with_row_id(scan, INCIDENT_COLUMNS), zones, raw, by_month=True, **settings)


def process_batch(
    rows: DataFrame,
    zones: Zones,
    raw: Mapping[BatchMonth, int],
    *,
    rules: Sequence[RuleGroup] | None = None,
    order: Sequence[Column | str] = TEXT_ORDER,
    rows_per_task: int = ROWS_PER_TASK,
    by_month: bool = False,
) -> DataFrame:
    """Check ``rows`` and write the valid and the rejected ones.

    ``rows`` has the incident columns, the batch keys and a row identity; ``raw`` names
    the months of the batch with the number of their rows. Returns one line per month:
    rows to read, and rows found in curated and rejected after the writes; raises
    `ReconciliationError` where they do not add up.

    The marked rows are written once, to a table in the shared folder from which both
    zones are filled and which goes afterwards. A batch of at most ``rows_per_task`` rows
    is laid out by month for that; in a larger one the rows keep their source's layout. If
    that is ``by_month`` and most rows may be rejected, those that fail the rules keep their
    place throughout: only valid rows go to the contest, and only duplicates are gathered.
    """
    # Content is hashed for rows that tie, not for all.
    checked = classify(place_only(rows), rules)
    aside = None
    if by_month:
        # Exploded from an array of one, so that the filters are not pushed into the rules.
        ruled = checked.withColumn(REJECT_REASON, F.explode(F.array(REJECT_REASON)))
        checked, aside = ruled.where(is_valid()), ruled.where(~is_valid())
    with borrowed(first_rows(checked, ROW_ID, order=order), "contest") as contest:
        winners = settle_ties(checked, contest, ROW_ID, INCIDENT_COLUMNS, order=order)
        marked = mark_duplicates(checked, winners, ROW_ID)
        if aside is not None:
            marked = marked.unionByName(aside)
        if sum(raw.values()) <= rows_per_task:
            cores = rows.sparkSession.sparkContext.defaultParallelism
            layout = MonthLayout.for_counts(raw, rows_per_task, min_tasks=cores)
            spread = F.xxhash64(f"{ROW_ID}.file", f"{ROW_ID}.row")
            marked = marked.repartitionById(layout.tasks, layout.task(spread))
        with borrowed(marked.drop(ROW_ID), "marked") as table:
            _write(table, zones, raw, F.col(REJECT_REASON) != DUPLICATE_REASON if by_month else None)
    return check_written(rows.sparkSession, zones, raw)


def _write(marked: DataFrame, zones: Zones, months: Iterable[BatchMonth], in_place: Column | None = None) -> None:
    """Write both zones, and empty what is left of earlier runs. Rejected rows ``in_place`` lie by month."""
    # Which months have rows of each kind is noted during the first write.
    seen = Observation("months")
    year, month = BATCH_KEYS
    number = F.col(year) * 100 + F.col(month)
    watched = marked.observe(
        seen,
        F.collect_set(F.when(is_valid(), number)).alias("curated"),
        F.collect_set(F.when(~is_valid(), number)).alias("rejected"),
    )
    write_curated(watched.where(is_valid()), zones)
    write_rejected(marked.where(~is_valid()), zones, in_place=in_place)

    found = seen.get

    def without(zone: str) -> list[BatchMonth]:
        return [m for m in months if m.year * 100 + m.month not in found[zone]]

    clear_curated(marked, zones, without("curated"))
    clear_rejected(marked, zones, without("rejected"))


def written_counts(
    spark: SparkSession, zones: Zones, months: Iterable[BatchMonth]
) -> dict[BatchMonth, tuple[int, int]]:
    """Rows per month in curated and rejected, from the footers of those months' files.

    A month that never had a valid row has no curated partition.
    """
    months = list(months)
    rejected = (
        spark.read.schema(REJECTED_SCHEMA)
        .option("basePath", zones.rejected)
        .parquet(*[zones.rejected_month(m) for m in months])
    )
    lines = labelled_counts(rejected, "rejected")
    there = existing_children(spark, zones.curated, 2)
    leaves = [leaf for m in months if (leaf := zones.curated_month(m)).removeprefix(f"{zones.curated}/") in there]
    if leaves:
        curated = (
            spark.read.schema(CURATED_SCHEMA).option("basePath", zones.curated).parquet(*leaves)
        )
        lines = lines.unionByName(labelled_counts(curated, "curated"))
    # Two lines per month at most.
    found = {(line[BATCH_MONTH], line["zone"]): line["rows"] for line in lines.collect()}
    return {
        m: (found.get((m.label, "curated"), 0), found.get((m.label, "rejected"), 0))
        for m in months
    }


def check_written(
    spark: SparkSession, zones: Zones, raw: Mapping[BatchMonth, int]
) -> DataFrame:
    """Compare the rows read with the rows that lie in curated and rejected."""
    written = written_counts(spark, zones, raw)
    lines = [(m.label, n, *written[m]) for m, n in sorted(raw.items())]
    wrong = [line for line in lines if line[1] != line[2] + line[3]]
    if wrong:
        raise ReconciliationError(f"rows read are not curated + rejected: {wrong}")
    return spark.createDataFrame(lines, RECONCILIATION)
