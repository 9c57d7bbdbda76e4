"""Stored progress of the jobs.

Every dataset has a small table of its own below the state's folder, so that drivers which
work on different datasets share nothing they write.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from threading import Lock
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions.keys import checkpoint_key
from medallion.operators.checkpoints import (
    ENTRY_SCHEMA,
    KEYSET_SCHEMA,
    PUBLISHED_SCHEMA,
    REFINED_SCHEMA,
    decoded,
    entry_rows,
    keyset_rows,
)
from medallion.operators.upsert import SourceProfile
from medallion.sources import files
from medallion.sources.lake import DeltaTable, ParquetTable

Table = ParquetTable | DeltaTable


def _own(table: Table, name: str) -> Table:
    """The table of one dataset."""
    return type(table)(table.spark, f"{table.path}/{name}")


def _read_all(table: Table, schema: str) -> DataFrame:
    """The rows of all datasets: one scan, however many there are."""
    names = [e.name for e in files.entries(table.spark, table.path) if e.name[0] not in "._"]
    own = [_own(table, name) for name in sorted(names)]
    if isinstance(table, DeltaTable):
        parts = [part.read() for part in own]
        return reduce(DataFrame.unionByName, parts, table.spark.createDataFrame([], schema))
    paths = [part.current_path() for part in own]
    if not paths:
        return table.spark.createDataFrame([], schema)
    return table.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*paths)


@dataclass(frozen=True)
class CheckpointState:
    """Greatest checkpoint value and last run of each dataset."""

    table: Table
    lock: Lock = field(default_factory=Lock, repr=False, compare=False)

    def entry(self, namespace: str, dataset: str) -> Row | None:
        """What the last run that was saved left behind."""
        own = _own(self.table, checkpoint_key(namespace, dataset))
        return own.read(ENTRY_SCHEMA).first() if own.exists() else None

    def bound(self, entry: Row | None, data_type: T.DataType) -> Column | None:
        """The stored checkpoint as a literal of the column's type."""
        return None if entry is None else decoded(entry.value, entry.value_type, data_type)

    def value(self, namespace: str, dataset: str) -> Any | None:
        """The stored checkpoint: a wall clock for dates and times, else as the column has it."""
        entry = self.entry(namespace, dataset)
        if entry is None or entry.last_timestamp is not None:
            return entry and entry.last_timestamp
        literal = F.lit(entry.value).cast(entry.value_type)
        return self.table.spark.range(1).select(literal).first()[0]

    def save(
        self,
        namespace: str,
        dataset: str,
        column: str,
        data_type: T.DataType,
        text: str,
        run_id: str,
    ) -> None:
        """Replace the dataset's entry; ``text`` is an ``encoded`` value."""
        own = _own(self.table, checkpoint_key(namespace, dataset))
        spark = self.table.spark
        own.replace(entry_rows(spark, namespace, dataset, column, data_type, text, run_id))
        own.expire()

    def read(self) -> DataFrame:
        """The entries of all datasets."""
        return _read_all(self.table, ENTRY_SCHEMA)

    def upsert(self, rows: DataFrame, profile: SourceProfile | None = None) -> None:
        """Merge the checkpoints of many datasets, summed up elsewhere, into one table: insert
        rows of new keys, update those of known keys, keep the rest."""
        with self.lock:
            self.table.merge(rows, ["key_column"], profile=profile)
            self.table.expire()


@dataclass(frozen=True)
class KeysetState:
    """Last processed id per table. Before the first poll there is none, or ``start``: with 0,
    ids up to 0 are never captured. With an ``overlap`` the ids published in so long a window
    below the last one are kept as well, so that a poll can look there for late ones."""

    table: Table
    start: int | None = None
    overlap: int = 0

    def value(self, name: str) -> int | None:
        own = _own(self.table, name)
        row = own.read(KEYSET_SCHEMA).first() if own.exists() else None
        return self.start if row is None else row.last_processed_id

    def published(self, name: str) -> DataFrame | None:
        """``id`` of what was published in the window, if that is known."""
        own = _own(self.table, f"_published/{name}")
        return own.read(PUBLISHED_SCHEMA) if own.exists() else None

    def save(self, name: str, value: int, published: DataFrame | None = None) -> None:
        """``published`` goes first: a job that stops in between publishes ids again, and
        leaves none out."""
        if published is not None:
            ids = _own(self.table, f"_published/{name}")
            ids.replace(published.where(F.col("id") > value - self.overlap))
            ids.expire(0)
        own = _own(self.table, name)
        own.replace(keyset_rows(self.table.spark, name, value))
        own.expire()

    def read(self) -> DataFrame:
        return _read_all(self.table, KEYSET_SCHEMA)


@dataclass(frozen=True)
class RefinedState:
    """Raw batches whose rows have reached the zones."""

    table: Table

    def pending(self, raw: ParquetTable, namespace: str, dataset: str) -> list[str]:
        """Complete batches of a raw table that are still to be refined."""
        spark, complete = raw.spark, raw.complete_batches()
        own = _own(self.table, checkpoint_key(namespace, dataset))
        if not complete or not own.exists():
            return complete
        found = spark.createDataFrame([(name,) for name in complete], "batch string")
        done = own.read(REFINED_SCHEMA).select("batch")
        return sorted(row.batch for row in found.join(done, "batch", "left_anti").collect())

    def add(self, namespace: str, dataset: str, batches: Sequence[str]) -> None:
        """Appends only, so nothing that another run has stored is written again."""
        key = checkpoint_key(namespace, dataset)
        rows = [(key, batch) for batch in batches]
        frame = self.table.spark.createDataFrame(rows, REFINED_SCHEMA).coalesce(1)
        _own(self.table, key).append(frame)

    def read(self) -> DataFrame:
        return _read_all(self.table, REFINED_SCHEMA)
