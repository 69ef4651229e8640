"""Readers and writers."""

from .evalset import EmptyEvalSet, QuarantineNotEmpty, check_eval_lines, numbered_lines, scan_eval_jsonl
from .gauges import format_gauge_lines, gauge_json, write_gauge_file
from .tables import (
    FEATURE_COLUMNS,
    changed_features,
    scan_sales_csv,
    scan_table,
    update_feature_table,
    write_drift_window,
    write_feature_table,
)

__all__ = [
    "EmptyEvalSet",
    "QuarantineNotEmpty",
    "FEATURE_COLUMNS",
    "changed_features",
    "check_eval_lines",
    "format_gauge_lines",
    "gauge_json",
    "numbered_lines",
    "scan_eval_jsonl",
    "scan_sales_csv",
    "scan_table",
    "update_feature_table",
    "write_drift_window",
    "write_feature_table",
    "write_gauge_file",
]
