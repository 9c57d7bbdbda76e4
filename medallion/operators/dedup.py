"""Duplicate removal.

All three forms reduce inside each input partition before they shuffle, so a
key or a group of copies that holds a third of the rows sends at most one row
per input partition to the reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def exact_distinct(df: DataFrame) -> DataFrame:
    """Remove rows that are equal in every column."""
    return df.dropDuplicates()


def one_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None
) -> DataFrame:
    """Keep one row per key: an arbitrary one, or the largest by ``order``."""
    if not order:
        return df.dropDuplicates(list(keys))
    return _first_ranked(df, keys, [_descending(c) for c in order])


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    checkpoint: str,
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the row with the greatest ``checkpoint`` per key, nulls last.

    ``tie_break`` defaults to all remaining columns, which makes the order total
    over distinct rows: the survivor is then the same whether or not exact
    copies are removed first, so no separate pass removes them. Null keys form
    one group.
    """
    if tie_break is None:
        tie_break = _remaining_columns(df, [*keys, checkpoint])
    return _first_ranked(df, keys, [_descending(c) for c in (checkpoint, *tie_break)])


def _descending(column: str) -> Column:
    return F.col(f"`{column}`").desc_nulls_last()


def _first_ranked(df: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    # Catalyst turns "rank = 1" into a group limit on both sides of the shuffle.
    rank = "__rank"
    window = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) == 1).drop(rank)


def _remaining_columns(df: DataFrame, used: Sequence[str]) -> list[str]:
    rest = [f for f in df.schema if f.name not in set(used)]
    unordered = [f.name for f in rest if not _orderable(f.dataType)]
    if unordered:
        raise ValueError(f"columns {unordered} cannot be ordered; name the tie_break columns")
    return [f.name for f in rest]


def _orderable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.StructType):
        return all(_orderable(f.dataType) for f in data_type)
    if isinstance(data_type, T.ArrayType):
        return _orderable(data_type.elementType)
    return not isinstance(data_type, (T.MapType, T.VariantType))
