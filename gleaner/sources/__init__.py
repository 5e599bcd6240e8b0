"""Readers, typed tables and sinks."""

from gleaner.sources.tables import table

__all__ = ["table"]
