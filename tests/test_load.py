from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from monthlake import BatchMonth, Zones, fixtures
from monthlake.plans import (
    LoadCounts,
    ReconciliationError,
    build_source,
    list_partitions,
    reconcile_source,
    slice_month_raw,
)
from monthlake.schema import INCIDENT_COLUMNS, INCIDENT_SCHEMA, SOURCE_SCHEMA
from monthlake.sources import count_months, read_incidents_csv, read_month, read_months, read_source

from core_records import SMALL

JAN, FEB = BatchMonth(2001, 1), BatchMonth(2001, 2)
JAN_DATE, FEB_DATE = "01/05/2001 01:00:00 AM", "02/05/2001 01:00:00 AM"


@pytest.fixture
def zones(tmp_path):
    return Zones(str(tmp_path / "lake"))


def months(spark, zones) -> list[tuple[int, int]]:
    return [tuple(row) for row in list_partitions(read_source(spark, zones)).collect()]


def test_months_and_quarantine(spark, zones, incidents):
    records = incidents({"Date": JAN_DATE}, {"Date": FEB_DATE}, {"Date": "bad", "Year": 2002})
    assert build_source(records, zones) == LoadCounts(total=3, valid=2, quarantined=1)
    assert months(spark, zones) == [(0, 0), (2001, 1), (2001, 2)]
    held = read_source(spark, zones).where("year = 0").first()
    # The quarantined row keeps its reported year.
    assert (held["YearReported"], held["_source_error"]) == (2002, "INVALID_DATE")
    assert read_source(spark, zones).where("year > 0 AND _source_error IS NOT NULL").isEmpty()


def test_partitions_follow_the_date_and_not_the_year_column(spark, zones, incidents):
    build_source(incidents({"Date": JAN_DATE, "Year": 1999}), zones)
    assert months(spark, zones) == [(2001, 1)]
    assert read_month(spark, zones, JAN).first()["Year"] == 1999


def test_no_quarantine_partition_without_bad_dates(spark, zones, incidents):
    build_source(incidents({}), zones)
    assert months(spark, zones) == [(2001, 5)]


def test_rebuild_drops_what_is_not_in_the_new_input(spark, zones, incidents):
    build_source(incidents({"Date": JAN_DATE}, {"Date": "bad"}), zones)
    build_source(incidents({"Date": FEB_DATE}), zones)
    assert months(spark, zones) == [(2001, 2)]


@pytest.mark.parametrize("session_mode", ["static", "dynamic"])
def test_write_modes_do_not_depend_on_the_session(spark, zones, incidents, session_mode):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", session_mode)
    try:
        build_source(incidents({"Date": JAN_DATE}), zones)
        build_source(incidents({"Date": FEB_DATE}), zones, mode="partitions")
        assert months(spark, zones) == [(2001, 1), (2001, 2)]
        build_source(incidents({"Date": FEB_DATE}), zones)
        assert months(spark, zones) == [(2001, 2)]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_unknown_mode(zones, incidents):
    with pytest.raises(ValueError):
        build_source(incidents({}), zones, mode="append")


def test_counts_must_add_up():
    with pytest.raises(ReconciliationError):
        LoadCounts(total=3, valid=1, quarantined=1).check()


def test_reconcile_source(spark, zones, incidents):
    build_source(incidents({}, {}, {"Date": None}), zones)
    assert reconcile_source(read_source(spark, zones)).collect() == [(3, 2, 1)]


def test_source_schema(spark, zones, incidents):
    build_source(incidents({}, {"Date": None}), zones)
    # As any other reader sees it, from the files.
    stored = spark.read.parquet(zones.source)
    assert stored.dtypes == [(f.name, f.dataType.simpleString()) for f in SOURCE_SCHEMA]


def test_one_file_per_month_from_many_input_tasks(spark, zones):
    records = fixtures.incidents(spark, SMALL).repartition(7)
    build_source(records, zones)
    files = read_source(spark, zones).select("year", "month", F.input_file_name().alias("f"))
    per_month = files.distinct().groupBy("year", "month").count()
    assert per_month.agg(F.max("count")).first()[0] == 1


def test_source_of_the_fixture_is_whole(spark, zones):
    records = fixtures.incidents(spark, SMALL)
    counts = build_source(records, zones)
    assert (counts.total, counts.quarantined) == (1529, 60)
    back = read_source(spark, zones).withColumnRenamed("YearReported", "Data Year")
    same = records.withColumnRenamed("Year", "Data Year")
    assert back.select(*same.columns).exceptAll(same).isEmpty()
    assert same.exceptAll(back.select(*same.columns)).isEmpty()


def test_read_month_has_the_incident_columns(spark, zones, incidents):
    records = incidents({"Date": JAN_DATE, "ID": "7"}, {"Date": FEB_DATE})
    build_source(records, zones)
    month = read_month(spark, zones, JAN)
    assert month.columns == INCIDENT_COLUMNS
    assert month.exceptAll(records.where("ID = '7'")).isEmpty() and month.count() == 1


def test_read_months_lists_only_those_months(spark, zones, incidents):
    build_source(incidents({"Date": JAN_DATE}, {"Date": FEB_DATE}), zones)
    scan = read_months(spark, zones, [FEB])
    assert all("year=2001/month=2" in path for path in scan.inputFiles())
    assert scan.select("_year", "_month").collect() == [(2001, 2)]


def test_row_ids_tell_copies_apart(spark, zones, incidents):
    build_source(incidents(*[{"Case Number": "same"}] * 5), zones)
    rows = read_months(spark, zones, [BatchMonth(2001, 5)])
    assert rows.select("_row_id").distinct().count() == 5
    assert rows.select("_row_id.content").distinct().count() == 1


def test_filter_on_the_tree_prunes_partitions(spark, zones, incidents):
    build_source(incidents({"Date": JAN_DATE}, {"Date": FEB_DATE}), zones)
    plan = read_source(spark, zones).where(JAN.predicate())._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "DataFilters: []" in text
    assert "year#" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_counting_months_reads_no_column(spark, zones, incidents):
    build_source(incidents({"Date": JAN_DATE}, {"Date": FEB_DATE}, {"Date": FEB_DATE}), zones)
    source = read_source(spark, zones)
    assert count_months(source) == {JAN: 1, FEB: 2}
    plan = source.groupBy("year", "month").count()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


class TestCsv:
    LINES = [
        ",".join(f'"{c}"' for c in INCIDENT_COLUMNS),
        '1,A1,05/03/2001 10:20:30 AM,"001XX W, MAIN ST",0110,THEFT,D,STREET,true,false,'
        "012,notint,3,4,05,6,7,2001,x,41.5,-87.5,here",
        "2,A2,05/03/2001 10:20:30 AM",
        "3,A3,05/04/2001 10:20:30 AM,b,i,p,d,l,TRUE,False,1,2,3,4,f,6,7,2001,x,1.5,2.5,loc,extra,more",
    ]

    @pytest.fixture
    def path(self, tmp_path):
        file = tmp_path / "in.csv"
        file.write_text("\n".join(self.LINES) + "\n")
        return str(file)

    @pytest.mark.parametrize("ansi", ["true", "false"])
    def test_values(self, spark, path, ansi):
        before = spark.conf.get("spark.sql.ansi.enabled")
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            df = read_incidents_csv(spark, path)
            assert df.schema == INCIDENT_SCHEMA
            one, two, three = df.orderBy("ID").collect()
        finally:
            spark.conf.set("spark.sql.ansi.enabled", before)
        assert (one["Block"], one["Beat"], one["District"]) == ("001XX W, MAIN ST", 12, None)
        assert one["FBI Code"] == "05" and one["Arrest"] is True and one["Latitude"] == 41.5
        assert two["ID"] == "2" and two["Block"] is None and two["Location"] is None
        assert three["Location"] == "loc" and three["Arrest"] is True and three["Domestic"] is False

    def test_columns_go_by_position(self, spark, tmp_path):
        (tmp_path / "a.csv").write_text("x,y,z\n1,A1,d\n")
        assert read_incidents_csv(spark, str(tmp_path / "a.csv")).first()["Case Number"] == "A1"

    def test_quoted_line_breaks(self, spark, tmp_path):
        (tmp_path / "a.csv").write_text('ID,Case Number\n1,"A\n1"\n2,A2\n')
        rows = read_incidents_csv(spark, str(tmp_path / "a.csv"), multiLine=True).collect()
        assert [(r["ID"], r["Case Number"]) for r in rows] == [("1", "A\n1"), ("2", "A2")]

    def test_load_from_csv(self, spark, path, zones):
        assert build_source(read_incidents_csv(spark, path), zones).total == 3


class TestSlice:
    def test_month_and_undated(self, incidents):
        records = incidents({"Date": JAN_DATE}, {"Date": FEB_DATE}, {"Date": "bad"}, {"Date": None})
        got = {r["Case Number"] for r in slice_month_raw(records, JAN).collect()}
        assert got == {"A0", "A2", "A3"}

    def test_month_alone(self, incidents):
        records = incidents({"Date": JAN_DATE}, {"Date": FEB_DATE}, {"Date": "bad"})
        rows = slice_month_raw(records, JAN, include_unparseable=False)
        assert rows.columns == INCIDENT_COLUMNS
        assert [r["Case Number"] for r in rows.collect()] == ["A0"]

    def test_same_month_of_another_year_is_left_out(self, incidents):
        records = incidents({"Date": JAN_DATE}, {"Date": "01/05/2002 01:00:00 AM"})
        assert slice_month_raw(records, JAN).count() == 1

    def test_unpadded_dates_count_as_undated(self, incidents):
        records = incidents({"Date": "2/5/2001 1:00:00 AM"})
        assert slice_month_raw(records, JAN).count() == 1
