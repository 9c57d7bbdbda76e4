"""Bounds of an incremental read. Plain column predicates, so they reach the
Parquet reader or the database."""

from __future__ import annotations

from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rows_since(df: DataFrame, column: str | None, value: Any | None) -> DataFrame:
    """Rows at or after a stored checkpoint, a value or a typed column. Rows equal
    to it are read again; refinement removes the repeats. No column or no value
    means a full read."""
    if not column or value is None:
        return df
    data_type = df.schema[column].dataType
    if isinstance(value, datetime) and isinstance(data_type, T.TimestampNTZType):
        # A literal would turn the wall clock into an instant of this machine's zone.
        value = value.isoformat(" ")
    return df.filter(F.col(column) >= F.lit(value).cast(data_type))


def rows_after(df: DataFrame, column: str = "id", value: int | None = None) -> DataFrame:
    """Rows with an id strictly above the last processed one; without one, all that have an id."""
    if value is None:
        return df.filter(F.col(column).isNotNull())
    return df.filter(F.col(column) > F.lit(value))


def largest(df: DataFrame, column: str, name: str = "last_value") -> DataFrame:
    """One row with the greatest value of ``column``; null for no rows."""
    return df.agg(F.max(column).alias(name))
