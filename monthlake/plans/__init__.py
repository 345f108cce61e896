from monthlake.plans.batch import (
    check_written,
    process_batch,
    process_months,
    process_raw_month,
    process_raw_months,
    reconcile,
    written_counts,
)
from monthlake.plans.catalog import (
    CURATED_TABLE,
    list_partitions,
    register_curated,
    table_partitions,
)
from monthlake.plans.load import (
    LoadCounts,
    ReconciliationError,
    build_source,
    reconcile_source,
    slice_month_raw,
    slice_months_raw,
    to_source,
)
from monthlake.plans.profile import CsvProfile, infer_types, profile_csv, schema_rows
from monthlake.plans.verify import (
    VerificationError,
    explain_month,
    pruned_partitions,
    require_month,
    require_months,
    require_sound,
    verify_content,
    verify_lake,
    verify_month,
    verify_raw_month,
    verify_source,
)

__all__ = [
    "infer_types",
    "process_raw_months",
    "slice_months_raw",
    "verify_content",
    "require_sound",
    "require_months",
    "pruned_partitions",
    "CURATED_TABLE",
    "CsvProfile",
    "LoadCounts",
    "ReconciliationError",
    "VerificationError",
    "build_source",
    "check_written",
    "explain_month",
    "list_partitions",
    "process_batch",
    "process_months",
    "process_raw_month",
    "profile_csv",
    "reconcile",
    "reconcile_source",
    "register_curated",
    "require_month",
    "schema_rows",
    "slice_month_raw",
    "table_partitions",
    "to_source",
    "verify_lake",
    "verify_month",
    "verify_raw_month",
    "verify_source",
    "written_counts",
]
