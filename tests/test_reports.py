from __future__ import annotations

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from monthlake.operators import (
    cumulative_months,
    month_counts,
    preview,
    top_categories,
    total_count,
    word_count,
)
from monthlake.plans import infer_types, profile_csv, schema_rows
from monthlake.sinks import write_report_csv
from monthlake.sources import read_lines
from monthlake.work import new_folder, shared_dir


def rows(df) -> list[tuple]:
    return [tuple(row) for row in df.collect()]


@pytest.fixture
def dated(spark):
    months = [(2001, 10), (2001, 2), (2002, 1), (2001, 2), (2001, 10), (2001, 10)]
    return spark.createDataFrame(months, "year int, month int")


def test_counts(dated):
    assert rows(total_count(dated)) == [(6,)]
    assert rows(month_counts(dated)) == [(2001, 2, 2), (2001, 10, 3), (2002, 1, 1)]


def test_running_total(dated):
    assert rows(cumulative_months(dated)) == [(2001, 2, 2, 2), (2001, 10, 3, 5), (2002, 1, 1, 6)]


def test_published_running_total(spark):
    # Published rows per month and the totals after each batch.
    added = [37853, 33608, 40339, 39852, 41579, 41464, 44370, 43755]
    totals = [37853, 71461, 111800, 151652, 193231, 234695, 279065, 322820]
    months = spark.createDataFrame([(i + 1, n) for i, n in enumerate(added)], "month int, n int")
    df = months.selectExpr("2001 AS year", "month", "explode(sequence(1, n)) AS i")
    assert [r["total"] for r in cumulative_months(df).collect()] == totals


def test_top_categories(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), (None,)], "kind string")
    assert rows(top_categories(df, "kind")) == [("b", 2), (None, 1), ("a", 1), ("c", 1)]


def test_preview(spark):
    df = spark.range(100)
    assert [r["id"] for r in preview(df, df["id"].desc(), rows=3).collect()] == [99, 98, 97]
    assert preview(df).count() == 10


class TestWords:
    def test_sample(self, spark):
        lines = spark.createDataFrame([("spark is great spark is fast hdfs is reliable",)], "value string")
        assert rows(word_count(lines)) == [
            ("is", 3), ("spark", 2), ("fast", 1), ("great", 1), ("hdfs", 1), ("reliable", 1)
        ]

    def test_blank_ends_and_empty_lines_give_empty_words(self, spark):
        lines = spark.createDataFrame([("  a b ",), ("",)], "value string")
        assert rows(word_count(lines)) == [("", 3), ("a", 1), ("b", 1)]

    def test_no_break_space_is_part_of_a_word(self, spark):
        lines = spark.createDataFrame([("a b\tc",)], "value string")
        assert rows(word_count(lines)) == [("a b", 1), ("c", 1)]

    def test_lines_of_files(self, spark, tmp_path):
        (tmp_path / "one.txt").write_text("x y\nx\n")
        (tmp_path / "two.txt").write_text("y x")
        assert rows(word_count(read_lines(spark, str(tmp_path)))) == [("x", 3), ("y", 2)]

    def test_counts_are_added_up_before_the_shuffle(self, spark):
        lines = spark.createDataFrame([("a",)], "value string")
        plan = word_count(lines)._jdf.queryExecution().executedPlan().toString()
        assert "partial_count" in plan and "Python" not in plan


class TestReport:
    def test_one_file_with_header(self, spark, tmp_path):
        report = spark.range(1000).repartition(8).selectExpr("id", "id % 3 AS rest").orderBy("id")
        path = tmp_path / "report"
        assert write_report_csv(report, str(path), single_file=True, order=["id"]) == 1000
        parts = list(path.glob("part-*"))
        assert len(parts) == 1
        lines = parts[0].read_text().splitlines()
        assert lines[:3] == ["id,rest", "0,0", "1,1"] and len(lines) == 1001

    def test_report_keeps_order_in_several_files(self, spark, tmp_path):
        report = spark.range(1000).repartition(8).orderBy("id")
        path = tmp_path / "report"
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            assert write_report_csv(report, str(path), order=["id"]) == 1000
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        parts = sorted(path.glob("part-*"))
        assert len(parts) > 1
        ids = [int(x) for p in parts for x in p.read_text().splitlines()[1:]]
        assert ids == list(range(1000))

    def test_replaces_an_earlier_report(self, spark, tmp_path):
        path = str(tmp_path / "report")
        write_report_csv(spark.range(5), path)
        assert write_report_csv(spark.range(2), path) == 2
        assert spark.read.option("header", True).csv(path).count() == 2


class TestProfile:
    def test_glob_types_and_sql(self, spark, tmp_path):
        (tmp_path / "a.csv").write_text("n,x,name,when\n1,0.5,b,2001-05-03 10:20:30\n")
        (tmp_path / "b.csv").write_text("n,x,name,when\n2,1.5,a,2001-05-04 10:20:30\n")
        (tmp_path / "other.txt").write_text("not,read\n")
        profile = profile_csv(spark, f"{tmp_path}/*.csv", "profiled")
        assert rows(profile.columns) == [
            (1, "n", "int", True),
            (2, "x", "double", True),
            (3, "name", "string", True),
            (4, "when", "timestamp", True),
        ]
        assert rows(profile.total) == [(2,)]
        assert profile.preview.count() == 2
        assert rows(spark.sql("SELECT name FROM profiled WHERE n = 2")) == [("a",)]

    def test_schema_rows(self, spark):
        assert rows(schema_rows(spark.range(1))) == [(1, "id", "bigint", False)]


class TestFolders:
    def test_shared_folder_is_the_one_the_session_names(self, spark):
        assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")

    def test_new_folders_are_apart(self, spark):
        one, two = new_folder(spark, "x"), new_folder(spark, "x")
        assert one != two and Path(one).is_dir()
        assert one.startswith(shared_dir(spark))


@pytest.mark.parametrize("ordered", [True, False])
def test_one_file_of_many_tasks(spark, tmp_path, ordered):
    """Sorted by ranges in many tasks, then one file with one header, quoted as Spark quotes."""
    rows = [(f'w"{i % 97}, x' if i % 5 else f"line{i}", i % 13) for i in range(500)]
    report = spark.createDataFrame(rows, 'word string, n int').repartition(8)
    path, order = str(tmp_path / "report"), [F.desc("n"), "word"] if ordered else []
    spark.range(3).write.csv(path)  # an earlier report
    assert write_report_csv(report, path, single_file=True, order=order) == 500
    (file,) = [f for f in os.listdir(path) if f.endswith(".csv")]
    with open(f"{path}/{file}", newline="") as content:
        assert content.readline() == "word,n\n"
    found = [tuple(r) for r in spark.read.option("header", True).schema(report.schema).option("escape", "\\").csv(path).coalesce(1).collect()]
    wanted = [(w, n) for w, n in rows]
    assert found == sorted(wanted, key=lambda r: (-r[1], r[0])) if order else sorted(found) == sorted(wanted)


def test_one_file_without_rows(spark, tmp_path):
    assert write_report_csv(spark.range(5).where("id > 9").selectExpr("int(id) AS a", "'x' AS b"), str(tmp_path / "r"), single_file=True, order=["a"]) == 0
    assert (tmp_path / "r" / "part-00000.csv").read_text() == "a,b\n"


def test_types_of_columns(spark):
    columns = {
        "i": ["1", "-2", None, " 3"], "l": ["1", "3000000000", "2", None], "d": ["1", "2.5", "1e3", "NaN"], "date": ["2020-01-05", "2021-12-31", None, None],
        "t": ["2020-01-05", "2020-01-05 10:11:12", None, None], "b": ["true", "FALSE", None, None], "s": ["1", "x", None, None], "n": [None] * 4,
    }
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} string" for c in columns))
    schema, nulls, rows = infer_types(df)
    assert [f.dataType.simpleString() for f in schema] == ["int", "bigint", "double", "date", "timestamp", "boolean", "string", "string"]
    assert rows == 4 and nulls == {c: v.count(None) for c, v in columns.items()}
    assert infer_types(df.limit(0))[2] == 0


def test_odd_column_names_and_sampling(spark):
    df = spark.createDataFrame([(str(i), "x") for i in range(1000)], "`a b.c` string, `A B.C2` string")
    schema, _, rows = infer_types(df, sampling_ratio=0.1)
    assert [f.name for f in schema] == df.columns and rows == 1000 and schema[0].dataType.simpleString() == "int"
