from monthlake.operators.dedupe import (
    DUPLICATE_REASON,
    TEXT_ORDER,
    contested_keys,
    count_hashes,
    dedupe_first,
    first_rows,
    mark_duplicates,
    settle_ties,
    time_order,
)
from monthlake.operators.layout import MonthLayout
from monthlake.operators.reports import (
    cumulative_months,
    month_counts,
    preview,
    top_categories,
    total_count,
    word_count,
    words,
)
from monthlake.operators.row_id import ROW_ID, place_only, with_row_id
from monthlake.operators.rules import (
    Rule,
    classify,
    incident_rules,
    is_valid,
    reject_reason,
    split,
)

__all__ = [
    "DUPLICATE_REASON",
    "MonthLayout",
    "ROW_ID",
    "Rule",
    "TEXT_ORDER",
    "classify",
    "contested_keys",
    "count_hashes",
    "cumulative_months",
    "dedupe_first",
    "incident_rules",
    "is_valid",
    "first_rows",
    "mark_duplicates",
    "month_counts",
    "place_only",
    "preview",
    "reject_reason",
    "settle_ties",
    "split",
    "time_order",
    "top_categories",
    "total_count",
    "with_row_id",
    "word_count",
    "words",
]
