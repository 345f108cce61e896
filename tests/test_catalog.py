from __future__ import annotations

import uuid

import pytest

from monthlake import BatchMonth, Zones
from monthlake.plans import (
    VerificationError,
    build_source,
    explain_month,
    list_partitions,
    process_months,
    register_curated,
    require_month,
    require_sound,
    table_partitions,
    verify_content,
    verify_lake,
    verify_month,
    verify_source,
)
from monthlake.schema import CURATED_SCHEMA
from monthlake.sinks import clear_curated
from monthlake.sources import read_source

JAN, FEB, OCT = (BatchMonth(2001, m) for m in (1, 2, 10))
JAN_DATE, FEB_DATE, OCT_DATE = (f"{m:02d}/05/2001 01:00:00 AM" for m in (1, 2, 10))


@pytest.fixture
def zones(tmp_path):
    return Zones(str(tmp_path / "lake"))


@pytest.fixture
def table(spark):
    name = f"default.t_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.fixture
def loaded(spark, zones, incidents):
    build_source(
        incidents({"Date": JAN_DATE}, {"Date": JAN_DATE}, {"Date": FEB_DATE}, {"Date": OCT_DATE},
                  {"Date": "bad"}),
        zones,
    )
    return zones


def rows(df) -> list[tuple]:
    return [tuple(row) for row in df.collect()]


class TestTable:
    def test_months_become_visible_batch_by_batch(self, spark, loaded, table):
        process_months(spark, loaded, [JAN])
        register_curated(spark, loaded, table)
        assert rows(table_partitions(spark, table)) == [(2001, 1)]
        process_months(spark, loaded, [OCT, FEB])
        assert rows(table_partitions(spark, table)) == [(2001, 1)]
        register_curated(spark, loaded, table)
        assert rows(table_partitions(spark, table)) == [(2001, 1), (2001, 2), (2001, 10)]
        assert spark.sql(f"SELECT COUNT(*) AS total FROM {table}").first()["total"] == 3

    def test_schema(self, spark, loaded, table):
        process_months(spark, loaded, [JAN])
        register_curated(spark, loaded, table)
        wanted = [(f.name, f.dataType.simpleString()) for f in CURATED_SCHEMA]
        assert spark.table(table).dtypes == wanted

    def test_registering_again_changes_nothing(self, spark, loaded, table):
        process_months(spark, loaded, [JAN])
        for _ in range(3):
            register_curated(spark, loaded, table)
        assert rows(table_partitions(spark, table)) == [(2001, 1)]

    def test_rerun_month_can_be_read_from_the_table(self, spark, loaded, table, incidents):
        process_months(spark, loaded, [JAN, FEB])
        register_curated(spark, loaded, table)
        assert spark.table(table).count() == 2
        build_source(
            incidents({"Date": JAN_DATE}, {"Date": JAN_DATE, "ID": "2"}), loaded, mode="partitions"
        )
        process_months(spark, loaded, [JAN])
        register_curated(spark, loaded, table)
        assert spark.table(table).count() == 3

    def test_month_filter_prunes_partitions(self, spark, loaded, table):
        process_months(spark, loaded, [JAN, FEB, OCT])
        register_curated(spark, loaded, table)
        month = spark.sql(f"SELECT * FROM {table} WHERE year = 2001 AND month = 1")
        assert month.count() == 1
        assert all("month=1/" in path for path in month.inputFiles())


class TestChecks:
    def test_verify_month(self, spark, loaded, table):
        process_months(spark, loaded, [JAN, FEB])
        register_curated(spark, loaded, table)
        assert rows(verify_month(spark, loaded, JAN, table)) == [("2001-01", 2, 1, 1, 1)]
        # No rejected row in February: sound all the same.
        assert rows(verify_month(spark, loaded, FEB, table)) == [("2001-02", 1, 1, 0, 1)]

    def test_month_1_is_not_month_10(self, spark, loaded, table):
        process_months(spark, loaded, [OCT])
        register_curated(spark, loaded, table)
        with pytest.raises(VerificationError, match="missing"):
            verify_month(spark, loaded, JAN, table)

    def test_stale_table_is_noticed(self, spark, loaded, table):
        process_months(spark, loaded, [JAN])
        register_curated(spark, loaded, table)
        clear_curated(read_source(spark, loaded), loaded, [JAN])
        spark.catalog.refreshTable(table)
        with pytest.raises(VerificationError, match="2 source rows, 0 curated"):
            verify_month(spark, loaded, JAN, table)

    def test_missing_results_are_noticed(self, spark, loaded, table, tmp_path, incidents):
        process_months(spark, loaded, [JAN])
        register_curated(spark, loaded, table)
        elsewhere = Zones(str(tmp_path / "elsewhere"))
        build_source(incidents({"Date": JAN_DATE}), elsewhere)
        with pytest.raises(VerificationError, match="missing"):
            verify_month(spark, elsewhere, JAN, table)

    def test_verify_lake(self, spark, loaded, table):
        process_months(spark, loaded, [JAN, FEB])
        register_curated(spark, loaded, table)
        assert rows(verify_lake(spark, loaded, table)) == [
            ("0000-00", 1, 0, 0, 0, True),
            ("2001-01", 2, 1, 1, 1, True),
            ("2001-02", 1, 1, 0, 1, True),
            ("2001-10", 1, 0, 0, 0, False),  # loaded, but not processed
        ]

    def test_verify_source(self, spark, loaded):
        assert rows(verify_source(spark, loaded)) == [(0, 0, 1), (2001, 1, 2), (2001, 2, 1), (2001, 10, 1)]

    def test_source_of_undated_rows_only(self, spark, zones, incidents):
        build_source(incidents({"Date": "bad"}), zones)
        with pytest.raises(VerificationError, match="no month"):
            verify_source(spark, zones)

    def test_require_month(self, spark, loaded):
        assert require_month(spark, loaded, JAN).count() == 2
        with pytest.raises(VerificationError, match="missing"):
            require_month(spark, loaded, BatchMonth(2001, 3))

    def test_require_month_with_rows(self, spark, loaded):
        empty = read_source(spark, loaded).limit(0).drop("year", "month")
        empty.write.mode("overwrite").parquet(loaded.source_month(JAN))
        with pytest.raises(VerificationError, match="empty"):
            require_month(spark, loaded, JAN)

    def test_list_partitions_returns_all(self, spark, loaded):
        assert rows(list_partitions(read_source(spark, loaded))) == [
            (0, 0), (2001, 1), (2001, 2), (2001, 10)
        ]

    def test_explain_month(self, spark, loaded):
        plan = "\n".join(r["plan"] for r in explain_month(spark, loaded, JAN).orderBy("line").collect())
        filters = plan.split("PartitionFilters: [")[1].split("]")[0]
        assert "= 2001)" in filters and "= 1)" in filters
        assert "DataFilters: []" in plan


class TestContent:
    def test_as_written(self, spark, loaded, table):
        process_months(spark, loaded, [JAN, FEB, OCT])
        register_curated(spark, loaded, table)
        found = rows(require_sound(verify_content(spark, loaded, table)))
        assert found == [("0000-00", 1, True), ("2001-01", 2, True), ("2001-02", 1, True), ("2001-10", 1, True)]

    def test_swapped_rows_are_found(self, spark, loaded, table):
        """Two months that exchange a row have the counts they should have, and other rows."""
        process_months(spark, loaded, [JAN, FEB, OCT])
        register_curated(spark, loaded, table)
        feb, octo = loaded.curated_month(FEB), loaded.curated_month(OCT)
        contents = {leaf: spark.read.parquet(leaf).collect() for leaf in (feb, octo)}
        schema = spark.read.parquet(feb).schema
        for leaf, other in ((feb, octo), (octo, feb)):
            spark.createDataFrame(contents[other], schema).write.mode("overwrite").parquet(leaf)
        assert all(row["sound"] for row in verify_lake(spark, loaded, table).collect())
        found = {row["batch_month"]: row["sound"] for row in verify_content(spark, loaded, table).collect()}
        assert found == {"0000-00": True, "2001-01": True, "2001-02": False, "2001-10": False}
        with pytest.raises(VerificationError, match="2001-02, 2001-10"):
            require_sound(verify_content(spark, loaded, table))
