from monthlake.sources.files import read_incidents_csv, read_lines
from monthlake.sources.lake import (
    as_records,
    count_months,
    labelled_counts,
    read_curated,
    read_month,
    read_months,
    read_rejected,
    read_source,
    scan_months,
)

__all__ = [
    "as_records",
    "count_months",
    "labelled_counts",
    "read_curated",
    "read_incidents_csv",
    "read_lines",
    "read_month",
    "read_months",
    "read_rejected",
    "read_source",
    "scan_months",
]
