from twintally.operators.content import (
    SchemaMismatch,
    content_check,
    distinct_fingerprints,
    row_fingerprint,
    rows_apart,
    rows_extra,
    rows_missing,
    schema_difference,
    schemas_match,
)
from twintally.operators.counts import (
    CountCheck,
    batch_row_count,
    count_rows,
    rolled_up_row_count,
    row_count_check,
    windowed_row_count,
)
from twintally.operators.stored import SourceChanged, stored_content_check
from twintally.operators.tree import content_check_tree

__all__ = [
    "CountCheck",
    "SchemaMismatch",
    "SourceChanged",
    "batch_row_count",
    "content_check",
    "content_check_tree",
    "count_rows",
    "distinct_fingerprints",
    "rolled_up_row_count",
    "row_count_check",
    "row_fingerprint",
    "rows_apart",
    "rows_extra",
    "rows_missing",
    "schema_difference",
    "schemas_match",
    "stored_content_check",
    "windowed_row_count",
]
