"""DataFrame → DataFrame operators."""

from lakemart.operators.aggregate import grouped_report, observed, ratios, row_counts
from lakemart.operators.ordering import numbered, sorted_by, top_k, with_position
from lakemart.operators.positional import (PositionalMismatch, ordinal_index, pinned_index, positional_audit,
                                           with_ordinal, zip_by_position)
from lakemart.operators.quality import (DataQualityError, check_accepted, check_expectations,
                                        check_not_null, gate_rows, ingest_summary,
                                        missing_period_files, missing_periods, reconcile,
                                        reconcile_rules, require_files, require_rows)
from lakemart.operators.schema import (SchemaError, conform, drop_overlap, extend, lower_names,
                                       overlap, pick, rename, tag)
from lakemart.operators.sets import stack_periods

__all__ = [
    "grouped_report", "observed", "ratios", "row_counts", "sorted_by", "numbered", "top_k", "with_position",
    "PositionalMismatch", "ordinal_index", "pinned_index", "positional_audit", "with_ordinal", "zip_by_position",
    "DataQualityError", "check_accepted", "check_expectations", "check_not_null",
    "ingest_summary", "missing_period_files", "missing_periods", "reconcile",
    "reconcile_rules", "gate_rows", "require_files", "require_rows", "SchemaError", "conform",
    "drop_overlap", "extend", "lower_names", "overlap", "pick", "rename", "tag", "stack_periods",
]
