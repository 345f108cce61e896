from monthlake.sinks.partitions import (
    clear_curated,
    clear_rejected,
    empty_partitions,
    replace_partitions,
    write_curated,
    write_rejected,
)
from monthlake.sinks.raw import write_raw_month, write_raw_months
from monthlake.sinks.reports import print_rows, write_report_csv

__all__ = [
    "print_rows",
    "clear_curated",
    "clear_rejected",
    "empty_partitions",
    "replace_partitions",
    "write_curated",
    "write_raw_month",
    "write_raw_months",
    "write_rejected",
    "write_report_csv",
]
