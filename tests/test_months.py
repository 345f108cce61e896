from __future__ import annotations

import pytest

from monthlake import BatchMonth, Zones
from monthlake.operators import MonthLayout


def test_parse():
    month = BatchMonth.parse("2001-05")
    assert (month.year, month.month, month.label) == (2001, 5, "2001-05")
    assert month.partition == "year=2001/month=5"


@pytest.mark.parametrize(
    "text",
    ["2001-1", "2001-13", "2001-00", "1999-01", "2101-01", "abc", "2001", "2001-05-01",
     "2001-05 ", " 2001-05", "2001-0５", 200101, None, ""],
)
def test_parse_refuses(text):
    with pytest.raises(ValueError):
        BatchMonth.parse(text)


def test_years_can_be_widened():
    assert BatchMonth.parse("1995-03", first_year=1900) == BatchMonth(1995, 3)


def test_months_order_by_time():
    assert sorted([BatchMonth(2001, 10), BatchMonth(2001, 2), BatchMonth(2000, 12)]) == [
        BatchMonth(2000, 12),
        BatchMonth(2001, 2),
        BatchMonth(2001, 10),
    ]


def test_zones():
    zones, month = Zones("/lake"), BatchMonth(2001, 1)
    assert zones.source_month(month) == "/lake/source/year=2001/month=1"
    assert zones.curated_month(month) == "/lake/curated/year=2001/month=1"
    assert zones.rejected_month(month) == "/lake/rejected/batch_month=2001-01"
    assert zones.raw_month(month) == "/lake/raw/2001-01"


class TestLayout:
    jan, feb, mar, jun = (BatchMonth(2001, m) for m in (1, 2, 3, 6))

    def test_large_month_gets_its_share_of_tasks(self):
        layout = MonthLayout.for_counts({self.jan: 10, self.feb: 1000, self.mar: 10}, 100)
        assert layout.widths == (1, 10, 1)
        assert layout.starts == (0, 1, 11)
        assert layout.tasks == 12

    def test_small_months_share_a_task(self):
        layout = MonthLayout.for_counts({self.jan: 10, self.feb: 20, self.mar: 90}, 100)
        assert layout.starts == (0, 0, 1)
        assert layout.tasks == 2

    def test_small_months_keep_all_cores_busy(self):
        counts = {BatchMonth(2000 + i // 12, i % 12 + 1): 10 for i in range(80)}
        assert MonthLayout.for_counts(counts, 10**6).tasks == 1
        assert MonthLayout.for_counts(counts, 10**6, min_tasks=8).tasks == 8

    def test_task_limit_raises_rows_per_task(self):
        layout = MonthLayout.for_counts({self.jan: 10**9}, 1000, max_tasks=50)
        assert layout.tasks == 50
        assert layout.rows_per_task == 2 * 10**7

    def test_gap_between_months(self, spark):
        layout = MonthLayout.for_counts({self.jan: 300, self.jun: 250}, 100)
        df = spark.createDataFrame(
            [(2001, m, h) for m in (1, 6) for h in range(50)], "_year int, _month int, h long"
        )
        rows = df.select("_month", layout.task(df["h"]).alias("task")).distinct().collect()
        by_month = {m: {r["task"] for r in rows if r["_month"] == m} for m in (1, 6)}
        assert len(by_month[1]) == 3 and len(by_month[6]) == 3
        assert not by_month[1] & by_month[6]
        assert by_month[1] | by_month[6] <= set(range(layout.tasks))

    def test_no_rows_and_no_months(self):
        assert MonthLayout.for_counts({self.jan: 0}).tasks == 1
        with pytest.raises(ValueError):
            MonthLayout.for_counts({})
