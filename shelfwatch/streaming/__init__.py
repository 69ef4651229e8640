"""Structured Streaming jobs over the same operators the batch side uses."""

from .drift import psi_stream, reference_bins, window_bin_counts, window_psi
from .requests import validate_stream
from .state import newest_changes, newest_stream, pit_join_stream, read_newest
from .tables import append_table, read_log_stream
from .truth import delayed_truth

__all__ = [
    "append_table",
    "delayed_truth",
    "newest_changes",
    "newest_stream",
    "pit_join_stream",
    "psi_stream",
    "read_log_stream",
    "read_newest",
    "reference_bins",
    "validate_stream",
    "window_bin_counts",
    "window_psi",
]
