"""Lake zones and the tables in them.

A Parquet table is a folder of Parquet files. Appends add files; a replacement
is written completely as a new version before it becomes current, so a reader
never sees half a table, a failed job leaves the old version in place, and a
table can be rewritten from its own content:

    <table>/part-*.parquet                    rows appended before any replacement
    <table>/run-<id>/batch-<n>/               rows of one ingest batch
    <table>/run-<id>/batch-<n>/_COMPLETE      marks it as complete
    <table>/_versions/00000007/               one replacement
    <table>/_versions/_commits/00000007       marks it as complete

The current version is the highest committed one. One writer per table at a
time; concurrent writers need Delta.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.upsert import BROADCAST_LIMIT, SourceProfile, profile_source, upsert
from medallion.sources import files
from medallion.sources.schemas import cast_to, read_together, reconciled

# Bucket prefix per environment, retention of the writer option
# and of the cleanup after a merge.
PREFIXES = {"PRODUCTION": "prd", "STAGING": "stg"}
DELTA_WRITER_RETENTION = "3 days"
RETENTION_HOURS = 72

COMPLETE = "_COMPLETE"


@dataclass(frozen=True)
class Lake:
    """Zones below ``root``, which ends where the bucket name starts."""

    spark: SparkSession
    root: str = "s3a://"
    environment: str = "PRODUCTION"
    storage_format: str = "parquet"

    def path(self, zone: str, namespace: str, dataset: str) -> str:
        if self.environment not in PREFIXES:
            raise ValueError(
                f"environment must be one of {sorted(PREFIXES)}, not {self.environment!r}"
            )
        prefix = PREFIXES[self.environment]
        return f"{self.root}{prefix}-lake-{zone}-{namespace}/{dataset}"

    def table(
        self, zone: str, namespace: str, dataset: str, storage_format: str | None = None
    ) -> ParquetTable | DeltaTable:
        kind = DeltaTable if (storage_format or self.storage_format) == "delta" else ParquetTable
        return kind(self.spark, self.path(zone, namespace, dataset))

    def read(self, zone: str, namespace: str, dataset: str) -> DataFrame:
        return self.table(zone, namespace, dataset).read()

    def write(
        self, df: DataFrame, zone: str, namespace: str, dataset: str, mode: str = "append"
    ) -> None:
        table = self.table(zone, namespace, dataset)
        if mode == "append":
            table.append(df)
        elif mode == "overwrite":
            table.replace(df)
        else:
            raise ValueError(f"mode must be append or overwrite, not {mode!r}")


@dataclass(frozen=True)
class Version:
    name: str
    committed_ms: int


@dataclass(frozen=True)
class ParquetTable:
    spark: SparkSession
    path: str

    def versions(self) -> list[Version]:
        """Committed versions, oldest first."""
        found = files.entries(self.spark, f"{self.path}/_versions/_commits")
        return sorted((Version(e.name, e.modified_ms) for e in found), key=lambda v: v.name)

    def exists(self) -> bool:
        return bool(self.versions()) or bool(self._plain_entries())

    def current_path(self) -> str:
        versions = self.versions()
        return f"{self.path}/_versions/{versions[-1].name}" if versions else self.path

    def read(
        self, schema: T.StructType | str | None = None, all_columns: bool = False
    ) -> DataFrame:
        """All rows. The columns are those of ``schema``, else those of some
        file, or with ``all_columns`` those of any file, which looks into each."""
        reader = self.spark.read.option("recursiveFileLookup", "true")
        if schema is not None:
            reader = reader.schema(schema)
        return reader.option("mergeSchema", all_columns).parquet(*self._finished())

    def _finished(self) -> list[str]:
        """The current version's folder, or what lies in it if an ingest batch is unfinished."""
        root = self.current_path()
        complete = self.complete_batches()
        if len(complete) == len(files.matching(self.spark, f"{root}/run-*/batch-*")):
            return [root]
        plain = [e.name for e in files.entries(self.spark, root) if e.name[0] not in "._"]
        names = complete + [name for name in plain if not name.startswith("run-")]
        if not names:
            raise ValueError(f"{root} has no complete ingest batch yet")
        return [f"{root}/{name}" for name in names]

    def append(self, df: DataFrame) -> None:
        df.write.mode("append").parquet(self.current_path())

    def add_batch(self, df: DataFrame, run_id: str, batch_id: int) -> None:
        """Append one ingest batch. Writing the same batch again replaces it."""
        path = f"{self.current_path()}/run-{run_id}/batch-{batch_id}"
        df.write.mode("overwrite").parquet(path)
        files.create_empty(self.spark, f"{path}/{COMPLETE}")

    def batches(self) -> list[str]:
        """Names of all ingest batches. An error if there are other rows."""
        root = self.current_path()
        names = []
        for run in files.entries(self.spark, root):
            if run.name.startswith("run-"):
                found = files.entries(self.spark, f"{root}/{run.name}")
                names += [f"{run.name}/{b.name}" for b in found if b.name.startswith("batch-")]
            elif not run.name.startswith(("_", ".")):
                raise ValueError(f"{root} has rows outside of ingest batches")
        return sorted(names)

    def complete_batches(self) -> list[str]:
        """Names of the ingest batches that are written to the end."""
        found = files.matching(self.spark, f"{self.current_path()}/run-*/batch-*/{COMPLETE}")
        return sorted("/".join(path.split("/")[-3:-1]) for path in found)

    def next_batch(self, run_id: str) -> int:
        """The first batch number of a run that is not complete, so that a run which starts
        again replaces what it left unfinished and nothing else."""
        done = {b for b in self.complete_batches() if b.startswith(f"run-{run_id}/")}
        number = 0
        while f"run-{run_id}/batch-{number}" in done:
            number += 1
        return number

    def read_batches(
        self,
        batches: Sequence[str],
        schema: T.StructType | str | None = None,
        narrower: str = "error",
    ) -> DataFrame:
        """Rows of some batches, with the columns of ``schema`` or of any file, each of the
        widest type that a batch has."""
        if schema is not None:
            paths = [f"{self.current_path()}/{batch}" for batch in batches]
            return self.spark.read.schema(schema).parquet(*paths)
        chosen = set(batches)
        names = [name for name in self._in_order() if name in chosen]
        return read_together(names, self._read_pieces, narrower)

    def read_widened(self, narrower: str = "error") -> DataFrame:
        """All rows, with the columns of any file, each of the widest type that a piece of the
        table has: a complete ingest batch, or a file beside them."""
        names = self._in_order()
        if not names:
            return self.read(all_columns=True)  # an error that names the table
        return read_together(names, self._read_pieces, narrower)

    def _in_order(self) -> list[str]:
        """Complete batches and what lies beside them, as they were written."""
        root = self.current_path()
        found = [
            ("/".join(e.path.split("/")[-3:-1]), e.modified_ms)
            for e in files.matching_entries(self.spark, f"{root}/run-*/batch-*/{COMPLETE}")
        ]
        for entry in files.entries(self.spark, root):
            if not entry.name.startswith(("_", ".", "run-")):
                found.append((entry.name, entry.modified_ms))
        return [name for name, _ in sorted(found, key=lambda e: (e[1], e[0]))]

    def _read_pieces(self, names: Sequence[str]) -> DataFrame:
        root = self.current_path()
        reader = self.spark.read.option("mergeSchema", "true")
        return reader.parquet(*[f"{root}/{name}" for name in names])

    def replace(self, df: DataFrame) -> None:
        """Make ``df`` the whole content. It may be derived from this table."""
        folder = f"{self.path}/_versions"
        taken = [int(e.name) for e in files.entries(self.spark, folder) if e.name.isdigit()]
        name = f"{max(taken, default=0) + 1:08d}"
        df.write.mode("errorifexists").parquet(f"{folder}/{name}")
        files.create_empty(self.spark, f"{folder}/_commits/{name}")

    def merge(
        self,
        source: DataFrame,
        keys: Sequence[str],
        newer_than: str | None = None,
        drop: Sequence[str] = (),
        profile: SourceProfile | None = None,
        broadcast_limit: int = BROADCAST_LIMIT,
        order: Sequence[str] = (),
        unique: bool = False,
        same: Sequence[str] = (),
    ) -> None:
        """Upsert ``source``, or load it if there is no table yet. Columns in
        ``drop`` leave the table, new ones of ``source`` come in, with nulls in
        the rows that stay, and a type gets as wide as both sides need. ``source`` is evaluated three times: hand in a stored
        frame if it is costly. ``order``, ``unique`` and ``same`` are those of ``upsert``."""
        profile = profile or profile_source(source, keys)
        profile.require_unique(keys)
        if not self.exists():
            self.replace(source)
            return
        lake = self.read().drop(*drop)
        wanted = list(reconciled(lake.schema, source.schema, self.path))
        lake, source = cast_to(lake, wanted), cast_to(source, wanted)
        self.replace(
            upsert(lake, source, keys, newer_than, profile, broadcast_limit, order, unique, same)
        )

    def expire(self, hours: float = RETENTION_HOURS) -> list[str]:
        """Delete what was replaced more than ``hours`` ago, and remains of
        writes that failed that long ago. Never the current version."""
        cutoff = time.time() * 1000 - hours * 3_600_000
        versions = self.versions()
        if not versions:
            return []
        folder = f"{self.path}/_versions"
        gone = []
        for old, new in zip(versions, versions[1:], strict=False):
            if new.committed_ms <= cutoff:
                files.delete(self.spark, f"{folder}/_commits/{old.name}")
                files.delete(self.spark, f"{folder}/{old.name}")
                gone.append(old.name)
        known = {v.name for v in versions}
        for entry in files.entries(self.spark, folder):
            unfinished = entry.name.isdigit() and entry.name not in known
            if unfinished and entry.modified_ms <= cutoff:
                files.delete(self.spark, f"{folder}/{entry.name}")
                gone.append(entry.name)
        if versions[0].committed_ms <= cutoff:
            for entry in self._plain_entries():
                files.delete(self.spark, f"{self.path}/{entry.name}")
                gone.append(entry.name)
        return gone

    def _plain_entries(self) -> list[files.Entry]:
        found = files.entries(self.spark, self.path)
        return [e for e in found if not e.name.startswith(("_", "."))]


@dataclass(frozen=True)
class DeltaTable:
    """The same operations on a Delta table. Needs the Delta jars in the session
    and, for a retention below Delta's own minimum, its check switched off."""

    spark: SparkSession
    path: str

    def exists(self) -> bool:
        return bool(files.entries(self.spark, f"{self.path}/_delta_log"))

    def read(
        self, schema: T.StructType | str | None = None, all_columns: bool = False
    ) -> DataFrame:
        """All rows; the table itself knows its columns."""
        return self.spark.read.format("delta").load(self.path)

    def read_widened(self, narrower: str = "error") -> DataFrame:
        """All rows; the table itself widens its types."""
        return self.read()

    def _writer(self, df: DataFrame, mode: str):
        writer = df.write.format("delta").mode(mode)
        return writer.option("deltaRetentionDuration", DELTA_WRITER_RETENTION)

    def append(self, df: DataFrame) -> None:
        self._writer(df, "append").save(self.path)

    def add_batch(self, df: DataFrame, run_id: str, batch_id: int) -> None:
        writer = self._writer(df, "append")
        writer.option("txnAppId", run_id).option("txnVersion", batch_id).save(self.path)

    def next_batch(self, run_id: str) -> int:
        """A number above all earlier ones: Delta ignores one that it has seen."""
        return time.time_ns()

    def batches(self) -> list[str]:
        raise ValueError("a Delta table has no ingest batches; refine all of it")

    def complete_batches(self) -> list[str]:
        return self.batches()

    def replace(self, df: DataFrame) -> None:
        self._writer(df, "overwrite").option("overwriteSchema", "true").save(self.path)

    def merge(
        self,
        source: DataFrame,
        keys: Sequence[str],
        newer_than: str | None = None,
        drop: Sequence[str] = (),
        profile: SourceProfile | None = None,
        broadcast_limit: int = BROADCAST_LIMIT,
        order: Sequence[str] = (),
        unique: bool = False,
        same: Sequence[str] = (),
    ) -> None:
        (profile or profile_source(source, keys)).require_unique(keys)
        if order:
            raise ValueError("Delta merges compare one column; name it as newer_than")
        if not self.exists():
            self.replace(source)
            return
        lake = self.read()
        if set(drop) & set(lake.columns):
            self.replace(lake.drop(*drop))
        view = f"merge_source_{uuid4().hex}"
        source.createOrReplaceTempView(view)
        try:
            self.spark.sql(merge_statement(self.path, view, keys, newer_than))
        finally:
            self.spark.catalog.dropTempView(view)

    def expire(self, hours: float = RETENTION_HOURS) -> list[str]:
        self.spark.sql(f"VACUUM delta.`{self.path}` RETAIN {hours} HOURS")
        return []


def with_columns_of(df: DataFrame, other: DataFrame) -> DataFrame:
    """``df`` with the columns that only ``other`` has, null."""
    missing = [f for f in other.schema if f.name not in df.columns]
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})


def merge_statement(
    path: str, view: str, keys: Sequence[str], newer_than: str | None = None
) -> str:
    matched = " AND ".join(f"lake.`{k}` = source.`{k}`" for k in keys)
    update = "WHEN MATCHED"
    if newer_than:
        column = f"`{newer_than}`"
        update += (
            f" AND (lake.{column} IS NULL OR source.{column} >= lake.{column})"
        )
    return (
        f"MERGE INTO delta.`{path}` AS lake USING {view} AS source ON {matched} "
        f"{update} THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )
