"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from medallion.sources import files

SHARED_FOLDER = "spark.checkpoint.dir"


def new_scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the cluster's shared folder. A temporary folder of
    this machine is used only by a local master that names no folder."""
    root = spark.conf.get(SHARED_FOLDER, None)
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError(f"set {SHARED_FOLDER} to a folder that every executor can reach")
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/medallion-{label}-{uuid4().hex}"


@contextmanager
def staged(spark: SparkSession, df: DataFrame, label: str) -> Iterator[DataFrame]:
    """Write ``df`` once and read it back, for a result that several jobs use.
    A lost executor then costs a re-read, not the whole lineage."""
    path = new_scratch(spark, label)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        files.delete(spark, path)
