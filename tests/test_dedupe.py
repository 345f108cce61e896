from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from monthlake import BatchMonth, Zones, fixtures
from monthlake.operators import (
    ROW_ID,
    classify,
    contested_keys,
    count_hashes,
    dedupe_first,
    first_rows,
    incident_rules,
    is_valid,
    place_only,
    time_order,
)
from monthlake.plans import build_source
from monthlake.sources import read_months


def kept(df) -> set[str]:
    return {row["Case Number"] for row in df.where(is_valid()).collect()}


def reasons(df) -> dict[str, str | None]:
    return {row["Case Number"]: row["reject_reason"] for row in df.collect()}


def dedupe(records, **settings):
    return dedupe_first(classify(fixtures.batched(records)), row_id="Case Number", **settings)


def test_dates_order_as_text(incidents):
    records = incidents({"Date": "01/05/2001 02:00:00 AM"}, {"Date": "01/05/2001 01:00:00 PM"})
    assert kept(dedupe(records)) == {"A1"}


def test_dates_can_order_by_time(incidents):
    records = incidents({"Date": "01/05/2001 02:00:00 AM"}, {"Date": "01/05/2001 01:00:00 PM"})
    assert kept(dedupe(records, order=time_order())) == {"A0"}


def test_ties_go_to_the_first_case_number(incidents):
    assert kept(dedupe(incidents({}, {}, {}))) == {"A0"}


def test_duplicate_of_a_rejected_row_stays(incidents):
    records = incidents({"Primary Type": None, "Date": "05/01/2001 01:00:00 AM"}, {})
    assert reasons(dedupe(records)) == {"A0": "PRIMARY_TYPE_NULL", "A1": None}


def test_rejected_rows_keep_their_reason(incidents):
    records = incidents({}, {}, {"Latitude": 0.0}, {"Latitude": 0.0})
    assert reasons(dedupe(records)) == {
        "A0": None,
        "A1": "DUPLICATE_ID",
        "A2": "INVALID_LAT",
        "A3": "INVALID_LAT",
    }


def test_same_id_in_two_months_stays_twice(incidents):
    records = incidents({"Date": "01/05/2001 01:00:00 AM"}, {"Date": "02/05/2001 01:00:00 AM"})
    assert kept(dedupe(records)) == {"A0", "A1"}


def test_null_ids_are_no_duplicates_of_each_other(incidents):
    assert set(reasons(dedupe(incidents({"ID": None}, {"ID": None}))).values()) == {"ID_NULL"}


def expected(rows) -> dict[str, str | None]:
    """The same by a plain loop over the rows."""
    first: dict[tuple, tuple] = {}
    for row in rows:
        if row["reject_reason"] is None:
            key = (row["_year"], row["_month"], row["ID"])
            rank = (row["Date"], row["Case Number"])
            first[key] = min(first.get(key, rank), rank)
    winners = {rank[1] for rank in first.values()}
    return {
        row["Case Number"]: row["reject_reason"]
        or (None if row["Case Number"] in winners else "DUPLICATE_ID")
        for row in rows
    }


@pytest.fixture
def crowded(incidents):
    """One ID has a third of the rows, one date another third; some rows fail a rule."""
    rng = random.Random(7)
    changes = []
    for i in range(600):
        changes.append(
            {
                "ID": None if i % 50 == 0 else "77" if i % 3 == 0 else str(rng.randrange(250)),
                "Case Number": f"{rng.choice('ABC')}{i:04d}",
                "Date": f"0{rng.randrange(1, 4)}/0{rng.randrange(1, 3)}/2001 0{rng.randrange(1, 3)}:00:00 AM",
                "Latitude": None if i % 40 == 1 else 41.5,
            }
        )
    return classify(fixtures.batched(incidents(*changes)))


PARTS = [1, 7, 50, 2_000_000]


@pytest.mark.parametrize("rows_per_task", PARTS)
def test_any_share_of_a_task_agrees_with_a_loop(crowded, rows_per_task):
    want = expected(crowded.collect())
    assert sum(reason == "DUPLICATE_ID" for reason in want.values()) > 100
    marked = dedupe_first(crowded, row_id="Case Number", rows_per_task=rows_per_task)
    assert reasons(marked) == want
    assert marked.columns == crowded.columns


@pytest.mark.parametrize("rows_per_task", PARTS)
def test_null_keys_are_one_key(incidents, rows_per_task):
    """Rules that let null IDs and undated rows pass: each null group keeps one row."""
    rng = random.Random(3)
    records = incidents(
        *[
            {
                "ID": rng.choice([None, None, "1", "2"]),
                "Date": rng.choice(["bad", None, "01/05/2001 01:00:00 AM", "02/05/2001 01:00:00 AM"]),
            }
            for _ in range(60)
        ]
    )
    open_rows = classify(fixtures.batched(records), incident_rules()[3:]).collect()
    marked = dedupe_first(
        classify(fixtures.batched(records), incident_rules()[3:]), row_id="Case Number", rows_per_task=rows_per_task
    )
    rank = lambda r: (r["Date"] is not None, r["Date"] or "", r["Case Number"])
    groups: dict[tuple, list] = {}
    for row in open_rows:
        groups.setdefault((row["_year"], row["_month"], row["ID"]), []).append(row)
    assert any(None in key for key in groups)
    assert kept(marked) == {min(rows, key=rank)["Case Number"] for rows in groups.values()}


@pytest.mark.parametrize("rows_per_task", PARTS)
def test_descending_order(crowded, rows_per_task):
    order = [F.col("Date").desc(), F.col("Case Number").desc()]
    marked = dedupe_first(crowded, row_id="Case Number", order=order, rows_per_task=rows_per_task)
    last: dict[tuple, tuple] = {}
    for r in crowded.collect():
        if r["reject_reason"] is None:
            key = (r["_year"], r["_month"], r["ID"])
            last[key] = max(last.get(key, ("", "")), (r["Date"], r["Case Number"]))
    assert kept(marked) == {case for _, case in last.values()}


@pytest.mark.parametrize("rows_per_task", PARTS)
def test_order_by_time(incidents, rows_per_task):
    records = incidents(
        {"Date": "01/05/2001 02:00:00 AM"},
        {"Date": "01/05/2001 01:00:00 PM"},
        {"Date": "01/05/2001 12:30:00 AM"},
    )
    assert kept(dedupe(records, order=time_order(), rows_per_task=rows_per_task)) == {"A2"}


def test_contested_keys(crowded):
    rows = [r for r in crowded.collect() if r["reject_reason"] is None]
    groups = Counter((r["_year"], r["_month"], r["ID"]) for r in rows)
    found = contested_keys(crowded).collect()
    assert sorted(r["_rows"] for r in found) == sorted(n for n in groups.values() if n > 1)


def test_keys_that_share_a_hash_are_told_apart(incidents, monkeypatch):
    monkeypatch.setattr("monthlake.operators.dedupe._hash_of", lambda key, scope: F.lit(1).cast("long"))
    records = incidents({"ID": "1"}, {"ID": "1"}, {"ID": "2"}, {"ID": None}, {"ID": "3"})
    assert kept(dedupe(records)) == {"A0", "A2", "A4"}


def test_one_first_per_contested_key(crowded):
    rows = first_rows(crowded, "Case Number", rows_per_task=5)
    assert rows.count() == contested_keys(crowded).count()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_and_no_forced_broadcast(crowded):
    marked = dedupe_first(crowded, row_id="Case Number")
    marked.collect()
    plan = plan_of(marked)
    assert "Python" not in plan and "hint" not in plan.lower()


def test_counting_hashes_combines_before_the_shuffle(crowded):
    plan = plan_of(count_hashes(crowded))
    assert "partial_count" in plan and "HashAggregate" in plan and "SortAggregate" not in plan


def test_contest_reads_few_columns_once(spark, zones_with_source):
    """The contest: one scan of rule, key and order columns, two rows a key and task to shuffle."""
    checked = classify(place_only(read_months(spark, zones_with_source, [BatchMonth.parse("2001-05")])))
    plan = plan_of(first_rows(checked, ROW_ID))
    (read,) = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    columns = {field.split("#")[0] for field in read.split(",")} - {"year", "month", "_metadata"}
    columns = {c for c in columns if not c.startswith(("file_", "_tmp_metadata", "row_index"))}
    assert columns == {"ID", "Case Number", "Date", "Primary Type", "YearReported", "Latitude", "Longitude"}
    assert plan.count("Exchange hashpartitioning") == 1 and "WindowGroupLimit" in plan and "Join" not in plan


def test_two_scans_in_all(crowded, spark, tmp_path):
    crowded.drop("reject_reason").write.parquet(str(tmp_path / "rows"))
    rows = classify(spark.read.parquet(str(tmp_path / "rows")))
    assert plan_of(dedupe_first(rows, row_id="Case Number")).count("FileScan parquet") == 2


@pytest.fixture
def zones_with_source(incidents, tmp_path):
    zones = Zones(str(tmp_path / "lake"))
    build_source(incidents({}, {"ID": "2"}), zones)
    return zones


def tied(incidents, tmp_path, name, changes):
    """Rows of one ID, date and case number as a source of its own, and the description that stays."""
    zones = Zones(str(tmp_path / name))
    records = incidents(*({"Case Number": "A"} | c for c in changes))
    build_source(records.coalesce(1), zones)
    marked = dedupe_first(classify(read_months(records.sparkSession, zones, [BatchMonth.parse("2001-05")])), row_id=ROW_ID)
    return [r["Description"] for r in marked.where(is_valid()).collect()], marked.count()


def test_ties_are_settled_by_content_before_place(incidents, tmp_path):
    changes = [{"Description": f"d{i}"} for i in range(5)]
    first, n = tied(incidents, tmp_path, "one", changes)
    again, m = tied(incidents, tmp_path, "other", changes[::-1])
    assert first == again and len(first) == 1 and n == m == 5


def test_equal_rows_leave_one(incidents, tmp_path):
    kept_rows, n = tied(incidents, tmp_path, "equal", [{}] * 7)
    assert len(kept_rows) == 1 and n == 7
