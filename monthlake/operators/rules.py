"""Row-level data-quality rules.

Rules come in ordered groups. Inside a group the first rule that fires gives the
reason; across groups the reasons add up, joined with ``;``. The whole set
compiles to one column expression, so a check of any number of rules is a single
projection inside the scan stage.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthlake.functions import event_time
from monthlake.schema import REJECT_REASON

# Parsed once per row by `classify`, for every rule that needs the date.
EVENT_TIME = "_event_time"


@dataclass(frozen=True)
class Rule:
    """A reason and the condition under which a row is rejected for it."""

    reason: str
    fires: Column


RuleGroup = Sequence[Rule]

# The box that holds all valid coordinates, bounds included.
LATITUDE_RANGE = (41.0, 43.0)
LONGITUDE_RANGE = (-88.5, -87.0)


def outside(column: str, bounds: tuple[float, float]) -> Column:
    """Whether a value lies outside closed bounds; NaN counts as above them."""
    low, high = bounds
    return (F.col(column) < low) | (F.col(column) > high)


def incident_rules() -> list[RuleGroup]:
    """The rules an incident record has to pass, except for uniqueness."""
    time = F.col(EVENT_TIME)
    return [
        [Rule("ID_NULL", F.col("ID").isNull())],
        [Rule("PRIMARY_TYPE_NULL", F.col("Primary Type").isNull())],
        [
            Rule("INVALID_DATE", time.isNull()),
            # A null Year makes the comparison null, so the row passes.
            Rule("YEAR_MISMATCH", F.year(time) != F.col("Year")),
        ],
        [
            Rule("NULL_GEO", F.col("Latitude").isNull() | F.col("Longitude").isNull()),
            Rule("INVALID_LAT", outside("Latitude", LATITUDE_RANGE)),
            Rule("INVALID_LON", outside("Longitude", LONGITUDE_RANGE)),
        ],
    ]


def first_reason(group: RuleGroup) -> Column:
    """Reason of the first rule that fires, or null."""
    head, *rest = group
    start = F.when(head.fires, F.lit(head.reason))
    return reduce(lambda chain, rule: chain.when(rule.fires, F.lit(rule.reason)), rest, start)


def reject_reason(groups: Sequence[RuleGroup]) -> Column:
    """All reasons of a row, or null for a valid row."""
    # concat_ws skips nulls, but gives '' and not null when all parts are null.
    return F.nullif(F.concat_ws(";", *[first_reason(g) for g in groups]), F.lit(""))


def classify(df: DataFrame, groups: Sequence[RuleGroup] | None = None) -> DataFrame:
    """Add ``reject_reason``; every row stays."""
    return (
        df.withColumn(EVENT_TIME, event_time("Date"))
        .withColumn(REJECT_REASON, reject_reason(groups or incident_rules()))
        .drop(EVENT_TIME)
    )


def is_valid() -> Column:
    return F.col(REJECT_REASON).isNull()


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows without the reason, and rejected rows with it.

    Both read ``df``: persist it first when both are going to be used.
    """
    return df.where(is_valid()).drop(REJECT_REASON), df.where(~is_valid())
