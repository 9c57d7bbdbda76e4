"""Queries over the test tables, each next to the SQL that checks it."""

from catalog import events, loading, refining, upserts, zones  # noqa: F401
from catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
