"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def words(column: str) -> Column:
    """Split on every single space; neighbouring spaces give empty words."""
    return F.split(F.col(column), " ")
