"""Registration of queries and what they share."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from medallion.sources import Lake, new_scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

LOAD_AT = datetime(2024, 2, 1, 10, 11, 12, 500000)
LOADED = "timestamp '2024-02-01 10:11:12'"
TS_MS = 1_706_745_600_000


def query(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name or ``name``, with its SQL."""

    def register(function: Query) -> Query:
        QUERIES[name or function.__name__] = function
        SQL[name or function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_lake(spark: SparkSession) -> Lake:
    return Lake(spark, root=new_scratch(spark, "lake") + "/")


def wall_clock(df: DataFrame) -> DataFrame:
    """The load timestamp without a zone, as the other engine has it."""
    return df.withColumn("timestamp_kafka", df["timestamp_kafka"].cast("timestamp_ntz"))
