"""Reconciliation of a source table with a target table on Spark."""

from twintally.operators import (
    CountCheck,
    SchemaMismatch,
    SourceChanged,
    batch_row_count,
    content_check,
    content_check_tree,
    rolled_up_row_count,
    row_count_check,
    rows_apart,
    rows_extra,
    rows_missing,
    schema_difference,
    stored_content_check,
    windowed_row_count,
)
from twintally.plans import CheckSpec, check_outcome, run_checks, spec_from_mapping
from twintally.sinks import append_summary, read_summary
from twintally.sources import FileSource, JdbcSource, conform, malformed_rows, read_range, read_source

__all__ = [
    "CheckSpec",
    "CountCheck",
    "FileSource",
    "JdbcSource",
    "SchemaMismatch",
    "SourceChanged",
    "append_summary",
    "batch_row_count",
    "check_outcome",
    "conform",
    "content_check",
    "content_check_tree",
    "malformed_rows",
    "read_range",
    "read_source",
    "read_summary",
    "rolled_up_row_count",
    "row_count_check",
    "rows_apart",
    "rows_extra",
    "rows_missing",
    "run_checks",
    "schema_difference",
    "spec_from_mapping",
    "stored_content_check",
    "windowed_row_count",
]
