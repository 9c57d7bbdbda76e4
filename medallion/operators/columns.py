"""Column selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def drop_restricted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop restricted columns; names the frame does not have are ignored."""
    return df.drop(*columns)
