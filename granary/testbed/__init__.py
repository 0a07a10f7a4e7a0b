"""The operators bound to the test tables, each with the SQL that must give the same rows."""

from granary.testbed.registry import QUERIES, Query, load_all

__all__ = ["QUERIES", "Query", "load_all"]
