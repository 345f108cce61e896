"""One entry per operator: a function of a session and a folder of the driver's tables.

Queries about stored zones run on a lake of all records, built once per session and
folder; queries that change one have their own.
"""

from __future__ import annotations

import functools
import threading
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthlake import BatchMonth, Zones, fixtures
from monthlake.months import month_label
from monthlake.functions import event_time
from monthlake.operators import (
    classify,
    cumulative_months,
    dedupe_first,
    incident_rules,
    is_valid,
    month_counts,
    preview,
    split,
    time_order,
    top_categories,
    total_count,
    word_count,
)
from monthlake.plans import (
    CsvProfile,
    build_source,
    pruned_partitions,
    list_partitions,
    process_months,
    process_raw_month,
    process_raw_months,
    profile_csv,
    reconcile,
    reconcile_source,
    register_curated,
    require_month,
    slice_month_raw,
    slice_months_raw,
    table_partitions,
    verify_content,
    verify_lake,
    verify_month,
    verify_raw_month,
    verify_source,
)
from monthlake.schema import BATCH_KEYS, INCIDENT_COLUMNS, MONTH_KEYS
from monthlake.sinks import write_raw_month, write_raw_months, write_report_csv
from monthlake.sources import (
    count_months,
    read_curated,
    read_incidents_csv,
    read_lines,
    read_month,
    read_rejected,
    read_source,
)
from monthlake.work import new_folder

Query = Callable[[SparkSession, str], DataFrame]

MONTH = BatchMonth.parse("2001-05")

# The coordinates can be NaN in rejected rows, which engines do not compare alike.
COORDINATES = {"Latitude": "latitude_nan", "Longitude": "longitude_nan"}
BATCH_NAMES = dict(zip(BATCH_KEYS, ["batch_year", "batch_month"]))


@dataclass(frozen=True)
class Lake:
    zones: Zones
    months: list[BatchMonth]
    table: str
    counts: DataFrame


_lakes: dict[tuple[str, str, str], Lake] = {}
_lock = threading.Lock()


def _table(spark: SparkSession, name: str, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _source_months(spark: SparkSession, zones: Zones) -> list[BatchMonth]:
    return sorted(count_months(read_source(spark, zones).where(F.col("year") > 0)))


def new_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Load all records, process all their months, register the result."""
    zones = Zones(new_folder(spark, "lake"))
    build_source(fixtures.incidents(spark, sf_dir), zones)
    months = _source_months(spark, zones)
    counts = process_months(spark, zones, months)
    table = f"default.curated_{uuid.uuid4().hex}"
    register_curated(spark, zones, table)
    return Lake(zones, months, table, counts)


def _kept(build: Callable[[SparkSession, str], Lake], spark: SparkSession, sf_dir: str) -> Lake:
    """The lake a function builds, built once per session and folder."""
    key = (build.__name__, spark.sparkContext.applicationId, sf_dir)
    with _lock:
        if key not in _lakes:
            _lakes[key] = build(spark, sf_dir)
        return _lakes[key]


def shared_lake(spark: SparkSession, sf_dir: str) -> Lake:
    return _kept(new_lake, spark, sf_dir)


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records with their reasons; undated ones form a batch of their own."""
    records = fixtures.batched(fixtures.incidents(spark, sf_dir))
    return dedupe_first(classify(records), row_id=fixtures.ROW_ID)


def _plain(df: DataFrame) -> DataFrame:
    """The coordinates with 0 for NaN, and columns that tell where that is so."""
    for name, flag in COORDINATES.items():
        nan = F.coalesce(F.isnan(name) & F.col(name).isNotNull(), F.lit(False))
        df = df.withColumn(flag, nan).withColumn(name, F.nanvl(name, F.lit(0.0)))
    return df


def _named(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(BATCH_NAMES)


def dq_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_named(classified(spark, sf_dir)))


def _reasons(spark: SparkSession, sf_dir: str, rules=None, **settings) -> DataFrame:
    """The reason of every record, deduplicated with these settings."""
    checked = classify(fixtures.batched(fixtures.incidents(spark, sf_dir)), rules)
    marked = dedupe_first(checked, row_id=fixtures.ROW_ID, **settings)
    return _named(marked.select("Case Number", *BATCH_KEYS, "reject_reason"))


def dedupe_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every contested key is ranked in several tasks, then between them."""
    return _reasons(spark, sf_dir, rows_per_task=1)


def dedupe_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reasons(spark, sf_dir, rules=incident_rules()[1:])


def dedupe_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reasons(spark, sf_dir, order=time_order())


def dedupe_descending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reasons(spark, sf_dir, order=[F.desc("Date"), F.desc("Case Number")])


def dq_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified(spark, sf_dir).groupBy("reject_reason").agg(F.count("*").alias("cnt"))


def dq_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = split(classified(spark, sf_dir))
    return _named(valid).drop("Year")


def dq_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = split(classified(spark, sf_dir))
    return _plain(_named(rejected))


def dq_month_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = classified(spark, sf_dir).where(is_valid())
    keys = [F.col(b).alias(m) for b, m in zip(BATCH_KEYS, MONTH_KEYS)]
    return month_counts(valid.select(*keys))


def reconcile_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named(reconcile(classified(spark, sf_dir)))


def source_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = Zones(new_folder(spark, "source"))
    build_source(fixtures.incidents(spark, sf_dir), zones)
    return _plain(read_source(spark, zones))


def source_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile_source(read_source(spark, shared_lake(spark, sf_dir).zones))


def source_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_partitions(read_source(spark, shared_lake(spark, sf_dir).zones))


def check_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify_source(spark, shared_lake(spark, sf_dir).zones)


def one_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(read_month(spark, shared_lake(spark, sf_dir).zones, MONTH))


def month_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    return total_count(require_month(spark, shared_lake(spark, sf_dir).zones, MONTH), "rows")


def raw_month_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(slice_month_raw(fixtures.incidents(spark, sf_dir), MONTH))


def raw_month_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The route over CSV: landing file, slice of a month, batch."""
    zones = Zones(new_folder(spark, "raw"))
    fixtures.incidents(spark, sf_dir).write.option("header", True).csv(zones.landing)
    landing = read_incidents_csv(spark, zones.landing)
    write_raw_month(slice_month_raw(landing, MONTH), zones, MONTH)
    process_raw_month(spark, zones, MONTH)
    verify_raw_month(spark, zones, MONTH)
    no_reason = F.lit(None).cast("string").alias("reject_reason")
    curated = read_curated(spark, zones).drop(*MONTH_KEYS).select("*", no_reason)
    rejected = read_rejected(spark, zones).drop("batch_month", "Year")
    return _plain(curated.unionByName(rejected))


def raw_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The route over CSV for all months: one pass over the landing file, one batch."""
    zones, months = Zones(new_folder(spark, "raw")), shared_lake(spark, sf_dir).months
    fixtures.incidents(spark, sf_dir).write.options(header=True, compression="gzip").csv(zones.landing)
    write_raw_months(slice_months_raw(read_incidents_csv(spark, zones.landing), months), zones, months)
    process_raw_months(spark, zones, months)
    curated = read_curated(spark, zones)
    curated = curated.withColumns({"batch_month": month_label(*MONTH_KEYS), "reject_reason": F.lit(None).cast("string")})
    rejected = read_rejected(spark, zones).drop("Year")
    return _plain(curated.drop(*MONTH_KEYS).unionByName(rejected))


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "csv") + "/records"
    fixtures.incidents(spark, sf_dir).write.option("header", True).csv(path)
    return _plain(read_incidents_csv(spark, path))


def batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_lake(spark, sf_dir).counts


def curated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_curated(spark, shared_lake(spark, sf_dir).zones)


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(read_rejected(spark, shared_lake(spark, sf_dir).zones))


def rerun_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake one month of which was processed a second time."""
    lake = new_lake(spark, sf_dir)
    process_months(spark, lake.zones, [MONTH])
    return lake


def curated_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = _kept(rerun_lake, spark, sf_dir).zones
    return read_curated(spark, zones)


def rejected_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = _kept(rerun_lake, spark, sf_dir).zones
    return _plain(read_rejected(spark, zones))


def emptied_month_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month is loaded again with rows that all fail, and processed again."""
    lake = new_lake(spark, sf_dir)
    failing = fixtures.batched(fixtures.incidents(spark, sf_dir)).where(
        (F.col("_year") == MONTH.year) & (F.col("_month") == MONTH.month)
    )
    no_type = F.lit(None).cast("string")
    build_source(failing.withColumn("Primary Type", no_type), lake.zones, mode="partitions")
    process_months(spark, lake.zones, [MONTH])
    register_curated(spark, lake.zones, lake.table)
    return verify_lake(spark, lake.zones, lake.table)


def empty_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month that never had a valid row is sound, and has no partition in the table."""
    zones = Zones(new_folder(spark, "lake"))
    in_month = F.date_trunc("month", event_time("Date")) == F.lit(f"{MONTH.label}-01").cast("timestamp")
    kind = F.when(in_month, F.lit(None)).otherwise(F.col("Primary Type"))
    build_source(fixtures.incidents(spark, sf_dir).withColumn("Primary Type", kind), zones)
    process_months(spark, zones, _source_months(spark, zones))
    table = f"default.curated_{uuid.uuid4().hex}"
    register_curated(spark, zones, table)
    return verify_month(spark, zones, MONTH, table)


def month_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(shared_lake(spark, sf_dir).table).where(MONTH.predicate())


def catalog_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return total_count(spark.table(shared_lake(spark, sf_dir).table))


def catalog_month_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = shared_lake(spark, sf_dir).table
    return spark.sql(
        f"SELECT year, month, COUNT(*) AS cnt FROM {table} GROUP BY year, month ORDER BY year, month"
    )


def catalog_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_partitions(spark, shared_lake(spark, sf_dir).table)


def running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cumulative_months(spark.table(shared_lake(spark, sf_dir).table))


def check_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = shared_lake(spark, sf_dir)
    return verify_month(spark, lake.zones, MONTH, lake.table)


def check_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = shared_lake(spark, sf_dir)
    return verify_lake(spark, lake.zones, lake.table)


def check_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = shared_lake(spark, sf_dir)
    return verify_content(spark, lake.zones, lake.table)


def month_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pruned_partitions(spark, shared_lake(spark, sf_dir).zones, MONTH)


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_categories(_table(spark, "orders", sf_dir), "o_orderpriority")


def first_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, "orders", sf_dir)
    columns = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return preview(columns, "o_orderkey")


def first_whole_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows with every column; what engines do not write alike goes as text."""
    return preview(_table(spark, "orders", sf_dir), "o_orderkey").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


def _profiled_orders(spark: SparkSession, sf_dir: str, view: str) -> CsvProfile:
    folder = new_folder(spark, "profile")
    _table(spark, "orders", sf_dir).write.option("header", True).csv(f"{folder}/orders")
    return profile_csv(spark, f"{folder}/orders/*.csv", view)


def csv_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profiled_orders(spark, sf_dir, f"data_{uuid.uuid4().hex}").columns


def csv_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profiled_orders(spark, sf_dir, f"data_{uuid.uuid4().hex}").total


def csv_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profiled_orders(spark, sf_dir, f"data_{uuid.uuid4().hex}").nulls


def csv_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = f"data_{uuid.uuid4().hex}"
    _profiled_orders(spark, sf_dir, view)
    return spark.sql(
        f"SELECT o_orderstatus, COUNT(*) AS cnt, SUM(o_custkey) AS custkeys "
        f"FROM {view} GROUP BY o_orderstatus"
    )


def document_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count(_table(spark, "documents", sf_dir), "text")


def line_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "text") + "/documents"
    _table(spark, "documents", sf_dir).select("text").write.text(path)
    return word_count(read_lines(spark, path))


def word_report(spark: SparkSession, sf_dir: str, single_file: bool = True) -> DataFrame:
    path = new_folder(spark, "report") + "/words"
    order = [F.desc("count"), "word"]
    write_report_csv(document_words(spark, sf_dir), path, single_file=single_file, order=order)
    return spark.read.schema("word string, count bigint").option("header", True).csv(path)


def word_report_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_report(spark, sf_dir, single_file=False)


def in_utc(query: Query) -> Query:
    """The records' dates are written and read without a zone."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {name: in_utc(query) for name, query in _QUERIES.items()}


_QUERIES: dict[str, Query] = {
    "dq_classified": dq_classified,
    "dq_reason_counts": dq_reason_counts,
    "dq_curated": dq_curated,
    "dq_rejected": dq_rejected,
    "dq_month_counts": dq_month_counts,
    "dedupe_parts": dedupe_parts,
    "dedupe_null_keys": dedupe_null_keys,
    "dedupe_by_time": dedupe_by_time,
    "dedupe_descending": dedupe_descending,
    "reconcile": reconcile_all,
    "source_quarantine": source_quarantine,
    "source_reconcile": source_reconcile,
    "source_partitions": source_partitions,
    "verify_source": check_source,
    "read_month": one_month,
    "require_month": month_required,
    "raw_month_slice": raw_month_slice,
    "raw_month_batch": raw_month_batch,
    "raw_months": raw_months,
    "csv_scan": csv_scan,
    "batch_counts": batch_counts,
    "curated_rows": curated_rows,
    "rejected_rows": rejected_rows,
    "curated_rerun": curated_rerun,
    "rejected_rerun": rejected_rerun,
    "emptied_month_rerun": emptied_month_rerun,
    "verify_empty_month": empty_month,
    "month_slice": month_slice,
    "catalog_total": catalog_total,
    "catalog_month_counts": catalog_month_counts,
    "catalog_partitions": catalog_partitions,
    "cumulative_months": running_total,
    "verify_month": check_month,
    "verify_lake": check_lake,
    "verify_content": check_content,
    "explain_month": month_plan,
    "top_categories": categories,
    "preview": first_orders,
    "preview_all": first_whole_orders,
    "csv_schema": csv_schema,
    "csv_total": csv_total,
    "csv_nulls": csv_nulls,
    "csv_sql": csv_sql,
    "word_count": document_words,
    "word_count_lines": line_words,
    "report_csv": word_report,
    "report_csv_parts": word_report_parts,
}
