"""Checkpoint state: one row per dataset, addressed by ``key_column``."""

from __future__ import annotations

from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions.keys import checkpoint_key

STATE_SCHEMA = (
    "namespace string, table_name string, key_column string, "
    "checkpoint_column string, last_timestamp timestamp_ntz"
)
#: State of one dataset: the value as text with its type, so that it does not depend on a zone.
ENTRY_SCHEMA = f"{STATE_SCHEMA}, value_type string, value string, run_id string"
KEYSET_SCHEMA = "key_column string, last_processed_id bigint"
PUBLISHED_SCHEMA = "id bigint"
REFINED_SCHEMA = "key_column string, batch string"


def checkpoint_rows(
    spark: SparkSession, namespace: str, dataset: str, column: str, value: datetime
) -> DataFrame:
    """The state row to upsert after a run."""
    return _one_row(spark).select(
        F.lit(namespace).alias("namespace"),
        F.lit(dataset).alias("table_name"),
        F.lit(checkpoint_key(namespace, dataset)).alias("key_column"),
        F.lit(column).alias("checkpoint_column"),
        F.lit(value.isoformat(" ")).cast("timestamp_ntz").alias("last_timestamp"),
    )


CHECKPOINT_TYPES = (
    T.IntegralType,
    T.DecimalType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
    T.StringType,
)


def checkpoint_type(df: DataFrame, column: str) -> T.DataType:
    """Type of a checkpoint column; an error if its values cannot be stored."""
    data_type = df.schema[column].dataType
    if not isinstance(data_type, CHECKPOINT_TYPES):
        raise ValueError(f"{column}: {data_type.simpleString()} cannot be a checkpoint")
    return data_type


def encoded(value: Column, data_type: T.DataType) -> Column:
    """A checkpoint as text: microseconds of UTC for an instant, else its own form."""
    if isinstance(data_type, T.TimestampType):
        value = F.unix_micros(value)
    return value.cast("string")


def decoded(text: str, stored_type: str, data_type: T.DataType) -> Column:
    """The checkpoint that was stored as ``text``, for a column of ``data_type``."""
    if stored_type == "timestamp":
        return F.timestamp_micros(F.lit(int(text))).cast(data_type)
    return F.lit(text).cast(stored_type).cast(data_type)


def entry_rows(
    spark: SparkSession,
    namespace: str,
    dataset: str,
    column: str,
    data_type: T.DataType,
    text: str,
    run_id: str,
) -> DataFrame:
    """The state row of one dataset after a run."""
    kind = data_type.simpleString()
    dated = isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType))
    clock = decoded(text, kind, T.TimestampNTZType()) if dated else F.lit(None)
    return _one_row(spark).select(
        F.lit(namespace).alias("namespace"),
        F.lit(dataset).alias("table_name"),
        F.lit(checkpoint_key(namespace, dataset)).alias("key_column"),
        F.lit(column).alias("checkpoint_column"),
        clock.cast("timestamp_ntz").alias("last_timestamp"),
        F.lit(kind).alias("value_type"),
        F.lit(text).alias("value"),
        F.lit(run_id).alias("run_id"),
    )


def keyset_rows(spark: SparkSession, name: str, value: int) -> DataFrame:
    """The state row to upsert after a poll."""
    return _one_row(spark).select(
        F.lit(name).alias("key_column"),
        F.lit(value).cast("bigint").alias("last_processed_id"),
    )


def _one_row(spark: SparkSession) -> DataFrame:
    return spark.range(0, 1, 1, 1)


def to_state(
    df: DataFrame, namespace: str, dataset_column: str, checkpoint: str
) -> DataFrame:
    """State for a frame that holds several datasets: the greatest checkpoint of
    each, summed up within partitions before the shuffle."""
    name = F.col(dataset_column).cast("string")
    return (
        df.groupBy(name.alias("table_name"))
        .agg(F.max(checkpoint).alias("last_timestamp"))
        .select(
            F.lit(namespace).alias("namespace"),
            "table_name",
            F.concat(F.lit(checkpoint_key(namespace, "")), F.col("table_name")).alias("key_column"),
            F.lit(checkpoint).alias("checkpoint_column"),
            "last_timestamp",
        )
    )


def lookup(state: DataFrame, key: str, value_column: str = "last_timestamp") -> DataFrame:
    """The stored value of one key: one row, or none."""
    return state.filter(F.col("key_column") == key).select(value_column).limit(1)


def last_value(state: DataFrame, key: str, value_column: str = "last_timestamp") -> Any | None:
    row = lookup(state, key, value_column).first()
    return None if row is None else row[0]
