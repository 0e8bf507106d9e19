from twintally.functions.measures import count_diff, percentage_diff, with_count_verdict, within_threshold
from twintally.functions.rowkey import row_digest, row_exact_text, row_struct, row_struct_digest, row_text
from twintally.functions.template import render, render_column
from twintally.functions.timing import (
    delayed,
    parse_process_time,
    process_time,
    resolve_process_time,
    truncate,
    truncate_time,
)

__all__ = [
    "count_diff",
    "delayed",
    "parse_process_time",
    "percentage_diff",
    "process_time",
    "render",
    "render_column",
    "resolve_process_time",
    "row_digest",
    "row_exact_text",
    "row_struct",
    "row_struct_digest",
    "row_text",
    "truncate",
    "truncate_time",
    "with_count_verdict",
    "within_threshold",
]
