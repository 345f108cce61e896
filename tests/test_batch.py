from __future__ import annotations

import os
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import monthlake.plans.batch as batch_module
from monthlake import BatchMonth, Zones, fixtures
from monthlake.operators import classify, dedupe_first, is_valid, time_order
from monthlake.plans import (
    ReconciliationError,
    build_source,
    process_months,
    process_raw_month,
    process_raw_months,
    reconcile,
    slice_month_raw,
    slice_months_raw,
)
from monthlake.schema import CURATED_SCHEMA, REJECTED_COLUMNS
from monthlake.sinks import write_raw_month, write_raw_months, write_rejected
from monthlake.sources import count_months, read_curated, read_incidents_csv, read_rejected, read_source
from monthlake.work import shared_dir

from core_records import SMALL

JAN, FEB = BatchMonth(2001, 1), BatchMonth(2001, 2)
JAN_DATE, FEB_DATE = "01/05/2001 01:00:00 AM", "02/05/2001 01:00:00 AM"


@pytest.fixture
def zones(tmp_path):
    return Zones(str(tmp_path / "lake"))


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    """A lake of all fixture records, all months processed at once."""
    zones = Zones(str(tmp_path_factory.mktemp("whole") / "lake"))
    build_source(fixtures.incidents(spark, SMALL), zones)
    months = sorted(count_months(read_source(spark, zones).where("year > 0")))
    return zones, months, process_months(spark, zones, months).collect()


def files(folder: str) -> dict[str, int]:
    return {str(p): p.stat().st_mtime_ns for p in Path(folder).rglob("*.parquet")}


def lines(df) -> list[tuple]:
    return [tuple(row) for row in df.collect()]


def curated(spark, zones) -> list[str]:
    return sorted(r["Case Number"] for r in read_curated(spark, zones).collect())


def rejected(spark, zones) -> dict[str, str]:
    return {r["Case Number"]: r["reject_reason"] for r in read_rejected(spark, zones).collect()}


def test_one_month(spark, zones, incidents):
    build_source(
        incidents({"Date": JAN_DATE}, {"Date": JAN_DATE}, {"Date": JAN_DATE, "ID": None},
                  {"Date": FEB_DATE}, {"Date": "bad"}),
        zones,
    )
    assert lines(process_months(spark, zones, [JAN])) == [("2001-01", 3, 1, 2)]
    assert curated(spark, zones) == ["A0"]
    assert rejected(spark, zones) == {"A1": "DUPLICATE_ID", "A2": "ID_NULL"}


def test_schemas_as_stored(spark, zones, incidents):
    build_source(incidents({}, {"ID": None}), zones)
    month = BatchMonth(2001, 5)
    process_months(spark, zones, [month])
    wanted = [(f.name, f.dataType.simpleString()) for f in CURATED_SCHEMA]
    assert spark.read.parquet(zones.curated).dtypes == wanted
    assert spark.read.parquet(zones.rejected_month(month)).columns == REJECTED_COLUMNS


def test_whole_fixture(spark, whole):
    _, months, report = whole
    assert len(report) == len(months) == 80
    assert sum(r["raw"] for r in report) == 1529 - 60
    assert sum(r["curated"] for r in report) == 1267
    assert all(r["raw"] == r["curated"] + r["rejected"] for r in report)


def test_many_months_at_once_equal_a_plain_window(spark, whole):
    zones, _, _ = whole
    records = fixtures.batched(fixtures.incidents(spark, SMALL)).where("_year IS NOT NULL")
    plain = dedupe_first(classify(records), row_id="Case Number")
    want = {r["Case Number"] for r in plain.where(is_valid()).collect()}
    assert set(curated(spark, zones)) == want
    reasons = {r["Case Number"]: r["reject_reason"] for r in plain.where(~is_valid()).collect()}
    assert rejected(spark, zones) == reasons


# Laid out by month; as the source is; as the source is, with frequent IDs in parts.
WAYS = {"small": {}, "large": {"rows_per_task": 20}, "parts": {"rows_per_task": 1}}


@pytest.mark.parametrize("way", ["large", "parts"])
def test_large_batches_give_the_same(spark, whole, way):
    zones, months, report = whole
    before = curated(spark, zones), rejected(spark, zones)
    again = process_months(spark, zones, months[30:42], **WAYS[way])
    assert again.collect() == report[30:42]
    assert (curated(spark, zones), rejected(spark, zones)) == before


@pytest.mark.parametrize("way", WAYS)
def test_no_table_is_left_behind(spark, zones, incidents, way):
    build_source(incidents({}, {}, {"ID": None}), zones)
    before = sorted(Path(shared_dir(spark)).iterdir())
    process_months(spark, zones, [BatchMonth(2001, 5)], **WAYS[way])
    with pytest.raises(Exception, match="no_such_column"):
        process_months(spark, zones, [BatchMonth(2001, 5)], order=["no_such_column"], **WAYS[way])
    assert sorted(Path(shared_dir(spark)).iterdir()) == before


@pytest.mark.parametrize("way", WAYS)
def test_copies_of_one_row_leave_exactly_one(spark, zones, incidents, way):
    build_source(incidents(*[{"Case Number": "same"}] * 100, {"ID": "2"}), zones)
    report = process_months(spark, zones, [BatchMonth(2001, 5)], **WAYS[way])
    assert lines(report) == [("2001-05", 101, 2, 99)]


@pytest.mark.parametrize("way", ["large", "parts"])
def test_ties_are_settled_alike_in_every_build_of_the_source(spark, tmp_path, incidents, way):
    changes = [{"ID": str(i % 3), "Case Number": "same", "Block": str(i)} for i in range(12)]
    blocks = set()
    for build, order in enumerate([changes, changes[::-1]]):
        zones = Zones(str(tmp_path / f"lake{build}"))
        build_source(incidents(*order).repartition(build + 1), zones)
        process_months(spark, zones, [BatchMonth(2001, 5)], **WAYS[way])
        blocks.add(tuple(sorted(r["Block"] for r in read_curated(spark, zones).collect())))
    assert len(blocks) == 1 and len(blocks.pop()) == 3


def test_rerun_gives_the_same_rows(spark, zones, incidents):
    build_source(incidents({}, {}, {"Year": 1}), zones)
    month = BatchMonth(2001, 5)
    first = lines(process_months(spark, zones, [month])), curated(spark, zones)
    assert (lines(process_months(spark, zones, [month])), curated(spark, zones)) == first


def test_rerun_leaves_other_months_alone(spark, zones, incidents):
    build_source(
        incidents({"Date": JAN_DATE}, {"Date": FEB_DATE}, {"Date": JAN_DATE, "ID": None},
                  {"Date": FEB_DATE, "ID": None}),
        zones,
    )
    process_months(spark, zones, [JAN, FEB])
    february = files(zones.curated_month(FEB)) | files(zones.rejected_month(FEB))
    january = files(zones.curated_month(JAN)) | files(zones.rejected_month(JAN))
    process_months(spark, zones, [JAN])
    assert february == files(zones.curated_month(FEB)) | files(zones.rejected_month(FEB))
    assert not january.keys() & files(zones.curated_month(JAN)).keys()


def test_month_added_later(spark, zones, incidents):
    build_source(incidents({"Date": JAN_DATE}, {"Date": FEB_DATE}), zones)
    process_months(spark, zones, [JAN])
    assert curated(spark, zones) == ["A0"]
    process_months(spark, zones, [FEB])
    assert curated(spark, zones) == ["A0", "A1"]


def test_month_without_valid_rows_is_emptied(spark, zones, incidents):
    build_source(incidents({"Date": JAN_DATE}, {"Date": FEB_DATE}), zones)
    process_months(spark, zones, [JAN, FEB])
    build_source(incidents({"Date": JAN_DATE, "ID": None}), zones, mode="partitions")
    assert lines(process_months(spark, zones, [JAN])) == [("2001-01", 1, 0, 1)]
    assert curated(spark, zones) == ["A1"]


def test_month_that_never_had_a_valid_row_has_no_partition(spark, zones, incidents):
    build_source(incidents({"Date": JAN_DATE, "ID": None}), zones)
    assert lines(process_months(spark, zones, [JAN])) == [("2001-01", 1, 0, 1)]
    assert not Path(zones.curated_month(JAN)).exists()
    assert rejected(spark, zones) == {"A0": "ID_NULL"}


def test_month_without_rejected_rows_is_emptied(spark, zones, incidents):
    build_source(incidents({"Date": JAN_DATE, "ID": None}), zones)
    process_months(spark, zones, [JAN])
    build_source(incidents({"Date": JAN_DATE}), zones)
    assert lines(process_months(spark, zones, [JAN])) == [("2001-01", 1, 1, 0)]
    assert rejected(spark, zones) == {}
    assert spark.read.parquet(zones.rejected_month(JAN)).columns == REJECTED_COLUMNS


def test_missing_month_fails_before_anything_is_written(spark, zones, incidents):
    build_source(incidents({"Date": JAN_DATE}), zones)
    with pytest.raises(AnalysisException):
        process_months(spark, zones, [JAN, FEB])
    assert not Path(zones.curated).exists()


def test_session_mode_does_not_matter(spark, zones, incidents):
    build_source(incidents({"Date": JAN_DATE}, {"Date": FEB_DATE}), zones)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        process_months(spark, zones, [JAN])
        process_months(spark, zones, [FEB])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert curated(spark, zones) == ["A0", "A1"]


def test_order_by_time(spark, zones, incidents):
    build_source(
        incidents({"Date": "01/05/2001 02:00:00 AM"}, {"Date": "01/05/2001 01:00:00 PM"}), zones
    )
    process_months(spark, zones, [JAN])
    assert curated(spark, zones) == ["A1"]
    process_months(spark, zones, [JAN], order=time_order())
    assert curated(spark, zones) == ["A0"]


def test_lost_rows_are_an_error(spark, zones, incidents, monkeypatch):
    build_source(incidents({"Date": JAN_DATE}, {"Date": JAN_DATE, "ID": None}), zones)
    write = batch_module.write_rejected
    monkeypatch.setattr(batch_module, "write_rejected", lambda df, z, **how: write(df.limit(0), z, **how))
    process = lambda: process_months(spark, zones, [JAN])
    # Nothing written to rejected: its month is missing altogether.
    with pytest.raises((ReconciliationError, AnalysisException)):
        process()


def test_nothing_stays_cached(spark, zones, incidents):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    build_source(incidents({}), zones)
    process_months(spark, zones, [BatchMonth(2001, 5)])
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_reconcile(incidents):
    checked = classify(fixtures.batched(incidents({}, {"ID": None}, {"Date": "bad"})))
    rows = {(r["_year"], r["_month"]): tuple(r)[2:] for r in reconcile(checked).collect()}
    assert rows == {(2001, 5): (2, 1, 1, True), (None, None): (1, 0, 1, True)}


def test_files_per_month(spark, tmp_path):
    zones = Zones(str(tmp_path / "lake"))
    build_source(fixtures.incidents(spark, SMALL), zones)
    months = sorted(count_months(read_source(spark, zones).where("year > 0")))[:9]
    process_months(spark, zones, months)
    found = read_curated(spark, zones).select("year", "month", F.input_file_name().alias("f"))
    assert found.distinct().count() == len(months)


class TestRawRoute:
    def test_undated_rows_are_rejected_with_the_batch(self, spark, zones, incidents):
        records = incidents({"Date": JAN_DATE}, {"Date": FEB_DATE}, {"Date": "bad", "ID": "9"},
                            {"Date": JAN_DATE})
        write_raw_month(slice_month_raw(records, JAN), zones, JAN)
        assert lines(process_raw_month(spark, zones, JAN)) == [("2001-01", 3, 1, 2)]
        assert curated(spark, zones) == ["A0"]
        assert rejected(spark, zones) == {"A2": "INVALID_DATE", "A3": "DUPLICATE_ID"}

    def test_both_routes_agree_on_dated_rows(self, spark, whole, tmp_path):
        zones, months, _ = whole
        month, apart = months[40], Zones(str(tmp_path / "raw"))
        records = fixtures.incidents(spark, SMALL)
        write_raw_month(slice_month_raw(records, month, include_unparseable=False), apart, month)
        process_raw_month(spark, apart, month)
        want = read_curated(spark, zones).where(month.predicate())
        got = read_curated(spark, apart)
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()

    @pytest.mark.parametrize("way", ["large", "parts"])
    def test_copies(self, spark, zones, incidents, way):
        records = incidents(*[{"Date": JAN_DATE, "Case Number": "same"}] * 60)
        write_raw_month(records, zones, JAN)
        report = process_raw_month(spark, zones, JAN, **WAYS[way])
        assert lines(report) == [("2001-01", 60, 1, 59)]


def test_many_raw_months_as_one_by_one(spark, zones, incidents, tmp_path):
    """One pass over the CSV and one batch give what the months give one after the other."""
    months = [BatchMonth(2001, 1), BatchMonth(2001, 2), BatchMonth(2001, 3)]
    records = incidents(
        {"Date": "01/05/2001 01:00:00 AM"}, {"Date": "01/06/2001 01:00:00 AM"}, {"Date": "02/05/2001 01:00:00 AM", "ID": "2"},
        {"Date": "never"}, {"Date": None}, {"Date": "04/05/2001 01:00:00 AM"},
    )
    write_raw_months(slice_months_raw(records, months), zones, months)
    assert lines(process_raw_months(spark, zones, months)) == [("2001-01", 4, 1, 3), ("2001-02", 3, 1, 2), ("2001-03", 2, 0, 2)]
    apart = Zones(str(tmp_path / "apart"))
    for month in months:
        write_raw_month(slice_month_raw(records, month), apart, month)
        process_raw_month(spark, apart, month)
    for read in (read_curated, read_rejected):
        assert sorted(map(str, read(spark, zones).collect())) == sorted(map(str, read(spark, apart).collect()))


def test_a_raw_month_without_rows(spark, zones, incidents):
    months = [BatchMonth(2001, 1), BatchMonth(2001, 7)]
    records = incidents({"Date": "01/05/2001 01:00:00 AM"}, {"Date": "never"})
    write_raw_months(slice_months_raw(records, months, include_unparseable=False), zones, months)
    assert lines(process_raw_months(spark, zones, months)) == [("2001-01", 1, 1, 0), ("2001-07", 0, 0, 0)]
    assert "_" not in {child[0] for child in os.listdir(zones.raw)}


def test_many_raw_months_scan_the_csv_once(spark, tmp_path, incidents):
    incidents({}).write.option("header", True).csv(str(tmp_path / "landing"))
    sliced = slice_months_raw(read_incidents_csv(spark, str(tmp_path / "landing")), [BatchMonth(2001, m) for m in range(1, 13)])
    assert sliced._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1


def test_raw_slices_are_written_compressed(spark, zones, incidents):
    """Undated records lie in every slice, so the slices are gzip files; they read back whole."""
    months = [BatchMonth(2001, 1), BatchMonth(2001, 2)]
    records = incidents({"Date": "01/05/2001 01:00:00 AM"}, {"Date": "never"})
    write_raw_months(slice_months_raw(records, months), zones, months)
    write_raw_month(slice_month_raw(records, BatchMonth(2001, 3)), zones, BatchMonth(2001, 3))
    for month, rows in ((months[0], 2), (months[1], 1), (BatchMonth(2001, 3), 1)):
        files = [p.name for p in Path(zones.raw_month(month)).glob("part-*")]
        assert files and all(name.endswith(".csv.gz") for name in files)
        assert read_incidents_csv(spark, zones.raw_month(month)).count() == rows


def test_rows_in_place_are_not_gathered(spark, zones, incidents):
    """Rejected rows that lie by month are written by the tasks that read them; duplicates are brought together."""
    rows = incidents(*({"ID": str(i)} for i in range(36))).withColumn("reject_reason", F.when(F.col("ID") < "2", "DUPLICATE_ID").otherwise("INVALID_DATE"))
    rows = rows.withColumns({"_year": F.lit(2001), "_month": F.lit(1)}).repartition(3)
    write_rejected(rows, zones, in_place=F.col("reject_reason") != "DUPLICATE_ID")
    files = list(Path(zones.rejected_month(BatchMonth(2001, 1))).glob("part-*"))
    assert len(files) == 4
    assert sorted(r.ID for r in read_rejected(spark, zones).collect()) == sorted(map(str, range(36)))


def test_raw_months_with_ties_and_undated_duplicates(spark, zones, incidents, tmp_path):
    """Only valid rows go to the contest of raw months: the same rows as month by month, with ties and rows rejected twice over."""
    months = [BatchMonth(2001, 1), BatchMonth(2001, 2)]
    january, february = {"Date": "01/05/2001 01:00:00 AM"}, {"Date": "02/05/2001 01:00:00 AM"}
    same = {"ID": "7", "Case Number": "S"}
    records = incidents(
        january | same | {"Block": "a"}, january | same | {"Block": "b"}, january | same | {"Block": "a"}, january | {"ID": "8"}, january | {"ID": "8", "Primary Type": None},
        february | same, {"Date": "never"} | same, {"Date": None} | same, {"Date": "never", "ID": None}, february | {"ID": None},
    )
    write_raw_months(slice_months_raw(records, months), zones, months)
    assert lines(process_raw_months(spark, zones, months)) == [("2001-01", 8, 2, 6), ("2001-02", 5, 1, 4)]
    apart = Zones(str(tmp_path / "apart"))
    for month in months:
        write_raw_month(slice_month_raw(records, month), apart, month)
        process_raw_month(spark, apart, month)
    for read in (read_curated, read_rejected):
        assert sorted(map(str, read(spark, zones).collect())) == sorted(map(str, read(spark, apart).collect()))
