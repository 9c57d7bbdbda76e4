"""Intermediate tables that several jobs read.

They are Parquet below the folder in ``spark.checkpoint.dir``, so a lost executor costs a
re-read and no lineage grows. A lazily evaluated result may still need them, so they stay for
the cluster to clean, but for those written within ``temporary``.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.sources import files, new_scratch

#: Texts are long rows: of the default 10,000 a worker would hold some 100 MB several times.
ARROW_BATCH = {"maxRecordsPerBatch": "1000", "maxBytesPerBatch": "16m"}
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 32  # what a row takes besides its values
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def stored(df: DataFrame, label: str, files_: int | None = None) -> DataFrame:
    """``df`` written once and read back, in at most ``files_`` files if its size is known."""
    spark = df.sparkSession
    path = new_scratch(spark, label)
    if (written := _written.get()) is not None:
        written.append(path)
    (df.coalesce(files_) if files_ else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parts(df: DataFrame, rows: int = 200_000) -> int:
    """Files of about ``rows`` rows that a table like the stored ``df`` fills."""
    return 1 + df.count() // rows


def _bytes(value: Column, kind: T.DataType) -> Column:
    """About the bytes that a value takes in memory."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType)):
            of = F.aggregate(value, F.lit(0), lambda n, e: n + _bytes(e, kind.elementType).cast("int"))
        else:
            of = 8 * F.greatest(F.size(value), F.lit(0))
        return F.coalesce(of, F.lit(0)) + 24
    if isinstance(kind, T.StructType):
        return sum((_bytes(value[f.name], f.dataType) for f in kind), F.lit(24))
    return F.lit(8)


def size_of(df: DataFrame) -> int:
    """About the bytes that a stored table takes in memory, from a pass over it."""
    each = sum((_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema), F.lit(ROW_BYTES))
    return df.agg(F.sum(each.cast("long"))).first()[0] or 0


def broadcast_within(df: DataFrame) -> DataFrame:
    """A stored table, to be broadcast if its bytes, which are measured, are within
    ``BROADCAST_BYTES``; else it is joined as Spark sees fit."""
    return F.broadcast(df) if size_of(df) <= BROADCAST_BYTES else df


def free(name: str, columns: list[str]) -> str:
    """``name``, lengthened until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


@contextmanager
def temporary(spark: SparkSession) -> Iterator[list[str]]:
    """The paths that ``stored`` writes inside; what the list still has at the end is deleted."""
    paths: list[str] = []
    token = _written.set(paths)
    try:
        yield paths
    finally:
        _written.reset(token)
        for path in paths:
            files.delete(spark, path)


def ship(spark: SparkSession) -> None:
    """Prepare a session for the operators that run Python in tasks: bound what a worker gets
    at once, and send this package to the workers, for callers that have neither ``--py-files``
    nor an installation on the executors."""
    for name, value in ARROW_BATCH.items():
        spark.conf.set(f"spark.sql.execution.arrow.{name}", value)
    context = spark.sparkContext
    if getattr(context, "_medallion_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="medallion-")) / "medallion.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, Path(package.name, path.relative_to(package)))
    context.addPyFile(str(target))
    context._medallion_shipped = True
