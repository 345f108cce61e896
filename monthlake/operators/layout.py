"""Where the rows of a batch go in its one shuffle.

A batch has to be grouped by key to find duplicates and by month to be written.
Both are met by one exchange when a task holds all rows of its keys and only few months:
the window then needs no further exchange, and each task writes a file per month. A
month gets as many tasks as its row count asks for, so a month with a third of all
rows is spread over a third of the tasks.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from monthlake.months import BatchMonth
from monthlake.schema import BATCH_KEYS

# About 150 MB of Parquet for records of this width.
ROWS_PER_TASK = 2_000_000
MAX_TASKS = 50_000


def _ordinal(month: BatchMonth) -> int:
    return month.year * 12 + month.month


@dataclass(frozen=True)
class MonthLayout:
    """First task and number of tasks per month, from the first month of the batch on.

    A large month has tasks of its own; small months that follow each other share one.
    """

    first_ordinal: int
    starts: tuple[int, ...]
    widths: tuple[int, ...]
    rows_per_task: int

    @classmethod
    def for_counts(
        cls,
        rows: Mapping[BatchMonth, int],
        rows_per_task: int = ROWS_PER_TASK,
        max_tasks: int = MAX_TASKS,
        min_tasks: int = 1,
    ) -> MonthLayout:
        """Plan from the rows per month (one entry per month, so small by nature).

        Small months share tasks as long as ``min_tasks`` are kept busy.
        """
        if not rows:
            raise ValueError("a layout needs at least one month")
        total = sum(rows.values())
        per_task = max(rows_per_task, -(-total // max_tasks), 1)
        shared = min(per_task, -(-total // min_tasks))
        by_ordinal = {_ordinal(m): n for m, n in rows.items()}
        first = min(by_ordinal)

        starts, widths = [], []
        task = -1  # the last task given out
        room = -1  # rows it can still take
        for ordinal in range(first, max(by_ordinal) + 1):
            count = by_ordinal.get(ordinal, 0)
            width = max(1, -(-count // per_task))
            if count <= room:
                room -= count
                starts.append(task)
            else:
                room = shared - count if width == 1 else 0
                starts.append(task + 1)
                task += width
            widths.append(width)
        return cls(first, tuple(starts), tuple(widths), per_task)

    @property
    def tasks(self) -> int:
        return self.starts[-1] + self.widths[-1]

    def task(self, spread: Column) -> Column:
        """Task of a row of month (``_year``, ``_month``), spread over its month's tasks.

        A month before the first or after the last one is an error, not a lost row.
        """
        year, month = BATCH_KEYS
        position = F.col(year) * 12 + F.col(month) - F.lit(self.first_ordinal - 1)
        inside = F.when(position >= 1, position).otherwise(F.raise_error(F.lit("a month before the first")))
        start = F.element_at(F.lit(list(self.starts)), inside)
        width = F.element_at(F.lit(list(self.widths)), inside)
        return (start + F.pmod(spread, width)).cast("int")
