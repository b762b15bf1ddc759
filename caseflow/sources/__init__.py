"""Sources and sinks."""

from .io import read_encoded, read_event_log, write_report, write_table

__all__ = ["read_event_log", "read_encoded", "write_table", "write_report"]
