"""Payload logs in, verdicts out."""

from commandwatch.sources.logs import (
    many_small_files,
    read_log,
    read_text_log,
    stream_log,
    stream_text_log,
)
from commandwatch.sources.scratch import scratch_dir
from commandwatch.sources.sinks import write_bucketed, write_files, write_table, write_verdict_lines

__all__ = [
    "many_small_files",
    "read_log",
    "read_text_log",
    "scratch_dir",
    "stream_log",
    "stream_text_log",
    "write_bucketed",
    "write_files",
    "write_table",
    "write_verdict_lines",
]
