from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from monthlake.functions import event_time
from monthlake.operators import Rule, classify, reject_reason, split

CASES = [
    ({}, None),
    ({"ID": None}, "ID_NULL"),
    ({"Primary Type": None}, "PRIMARY_TYPE_NULL"),
    ({"Date": None}, "INVALID_DATE"),
    ({"Date": "not a date"}, "INVALID_DATE"),
    ({"Date": "5/3/2001 10:20:30 AM"}, "INVALID_DATE"),
    ({"Date": "02/30/2001 10:20:30 AM"}, "INVALID_DATE"),
    ({"Date": "05/03/2001 13:20:30 PM"}, "INVALID_DATE"),
    ({"Date": "05/03/2001 10:20:30 AM "}, "INVALID_DATE"),
    ({"Date": "05/03/2001 10:20:30 pm"}, None),
    ({"Date": "05/03/2001 12:00:00 AM"}, None),
    ({"Year": 2002}, "YEAR_MISMATCH"),
    ({"Year": None}, None),
    ({"Date": "not a date", "Year": 1990}, "INVALID_DATE"),
    ({"Latitude": None}, "NULL_GEO"),
    ({"Longitude": None}, "NULL_GEO"),
    ({"Latitude": 41.0, "Longitude": -88.5}, None),
    ({"Latitude": 43.0, "Longitude": -87.0}, None),
    ({"Latitude": 40.999}, "INVALID_LAT"),
    ({"Latitude": 43.001}, "INVALID_LAT"),
    ({"Latitude": float("nan")}, "INVALID_LAT"),
    ({"Longitude": -88.501}, "INVALID_LON"),
    ({"Longitude": -86.999}, "INVALID_LON"),
    ({"Longitude": float("nan")}, "INVALID_LON"),
    # the first rule of a group wins
    ({"Latitude": 40.0, "Longitude": -80.0}, "INVALID_LAT"),
    ({"Latitude": None, "Longitude": -80.0}, "NULL_GEO"),
    # groups add up, in their order
    (
        {"ID": None, "Primary Type": None, "Date": "x", "Latitude": None},
        "ID_NULL;PRIMARY_TYPE_NULL;INVALID_DATE;NULL_GEO",
    ),
    ({"Year": 1999, "Longitude": 0.0}, "YEAR_MISMATCH;INVALID_LON"),
]


def test_every_rule(incidents):
    rows = classify(incidents(*[change for change, _ in CASES])).collect()
    found = {row["Case Number"]: row["reject_reason"] for row in rows}
    assert found == {f"A{i}": reason for i, (_, reason) in enumerate(CASES)}


def test_classify_adds_one_column_and_keeps_all_rows(incidents):
    records = incidents({}, {"ID": None})
    checked = classify(records)
    assert checked.columns == records.columns + ["reject_reason"]
    assert checked.count() == 2


def test_split(incidents):
    valid, rejected = split(classify(incidents({}, {"ID": None}, {"Year": 1})))
    assert "reject_reason" not in valid.columns
    assert valid.count() == 1
    assert sorted(r["reject_reason"] for r in rejected.collect()) == ["ID_NULL", "YEAR_MISMATCH"]


def test_rules_of_ones_own(spark):
    df = spark.createDataFrame([(1,), (5,), (20,)], "n int")
    groups = [
        [Rule("SMALL", F.col("n") < 3), Rule("BELOW_10", F.col("n") < 10)],
        [Rule("ODD", F.col("n") % 2 == 1)],
    ]
    rows = df.withColumn("reason", reject_reason(groups)).collect()
    assert [r["reason"] for r in rows] == ["SMALL;ODD", "BELOW_10;ODD", None]


def test_times(spark):
    df = spark.createDataFrame(
        [("01/05/2001 12:00:00 AM",), ("01/05/2001 12:00:00 pm",), ("01/05/2001",)], "Date string"
    )
    got = [str(r[0]) for r in df.select(event_time("Date").cast("string")).collect()]
    assert got == ["2001-01-05 00:00:00", "2001-01-05 12:00:00", "None"]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_dates_never_end_the_job(spark, incidents, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert classify(incidents({"Date": "13/45/2001 xx"})).first()["reject_reason"] == "INVALID_DATE"
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_rules_are_one_projection_without_shuffle(incidents):
    plan = classify(incidents({}))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
