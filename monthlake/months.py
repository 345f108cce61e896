"""Batch months: the unit that is checked, written and replaced."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_LABEL = re.compile(r"(\d{4})-(\d{2})", re.ASCII)

# The years a batch may name.
FIRST_YEAR = 2001
LAST_YEAR = 2100


@dataclass(frozen=True, order=True)
class BatchMonth:
    """One calendar month, ordered by time."""

    year: int
    month: int

    def __post_init__(self) -> None:
        if not 1 <= self.month <= 12:
            raise ValueError(f"month out of range (1-12): {self.month}")

    @classmethod
    def parse(
        cls, text: str, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR
    ) -> BatchMonth:
        """Read a ``YYYY-MM`` label; anything else is a ``ValueError``."""
        match = _LABEL.fullmatch(text) if isinstance(text, str) else None
        if match is None:
            raise ValueError(f"a batch month must be a YYYY-MM string, got {text!r}")
        year, month = map(int, match.groups())
        if not first_year <= year <= last_year:
            raise ValueError(f"year out of range ({first_year}-{last_year}): {text!r}")
        return cls(year, month)

    @property
    def label(self) -> str:
        return f"{self.year:04d}-{self.month:02d}"

    @property
    def partition(self) -> str:
        """Relative directory of the month; Spark writes the values unpadded."""
        return f"year={self.year}/month={self.month}"

    def predicate(self) -> Column:
        """Filter on the partition columns, which prunes the scan to one directory."""
        return (F.col("year") == self.year) & (F.col("month") == self.month)


def month_label(year: str, month: str) -> Column:
    """The ``YYYY-MM`` label of a row, from its year and month columns."""
    digits = [F.lpad(F.col(c).cast("string"), n, "0") for c, n in ((year, 4), (month, 2))]
    return F.concat_ws("-", *digits)
