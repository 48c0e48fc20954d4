"""Scans and sinks."""

from tidemill.sources.tables import read_table  # noqa: F401
