"""Load timestamps and the guard against impossible dates."""

from __future__ import annotations

import time
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Name of the load timestamp, first year that is taken for real.
LOAD_COLUMN = "timestamp_kafka"
FIRST_VALID_YEAR = 10

GUARDED_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def load_instant(at: datetime | None = None) -> Column:
    """The instant of a run, cut to the second, now by default: a literal, so that a
    recomputed task stamps the same value. A wall clock without a zone is one of the
    session's zone."""
    if at is not None and at.tzinfo is None:
        return F.lit(at.replace(microsecond=0).isoformat(" ")).cast("timestamp")
    return F.timestamp_seconds(F.lit(int(time.time() if at is None else at.timestamp())))


def with_load_timestamp(
    df: DataFrame, at: datetime | None = None, column: str = LOAD_COLUMN
) -> DataFrame:
    """Add one constant load timestamp to every row."""
    return df.withColumn(column, load_instant(at))


def date_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, GUARDED_TYPES)]


def guard_dates(df: DataFrame) -> DataFrame:
    """Null out every date or timestamp whose year lies before year 10."""
    guarded = {
        c: F.when(F.year(F.col(f"`{c}`")) >= FIRST_VALID_YEAR, F.col(f"`{c}`"))
        for c in date_columns(df)
    }
    return df.withColumns(guarded) if guarded else df
