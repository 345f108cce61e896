"""Expressions over the record's own date text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from monthlake.months import BatchMonth

# Fixed value: how dates are spelled in the records.
EVENT_DATE_FORMAT = "MM/dd/yyyy hh:mm:ss a"


def event_time(text: Column | str = "Date") -> Column:
    """Timestamp of a date text, or null where the text is not a date.

    ``try_to_timestamp`` because ``to_timestamp`` ends the job on bad text in ANSI mode.
    """
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text, F.lit(EVENT_DATE_FORMAT))


def falls_in(time: Column, month: BatchMonth) -> Column:
    """Whether a timestamp lies in the month; null for a null timestamp."""
    return (F.year(time) == month.year) & (F.month(time) == month.month)
