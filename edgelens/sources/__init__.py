"""Input tables and result sinks."""

from edgelens.sources.tables import TableSet, run_sql

__all__ = ["TableSet", "run_sql"]
