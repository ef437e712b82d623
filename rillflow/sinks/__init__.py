"""Sinks: topic records (Kafka or a folder), compacted tables, console labels."""

from rillflow.sinks.console import for_each_record, labeled, print_stream, window_lines
from rillflow.sinks.tables import CompactedTable
from rillflow.sinks.topics import write_records, write_records_stream

__all__ = ["write_records", "write_records_stream", "CompactedTable", "print_stream",
           "labeled", "for_each_record", "window_lines"]
