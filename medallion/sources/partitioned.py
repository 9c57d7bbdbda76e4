"""Zone tables in partitions, of which a merge rewrites those that it touches.

A row's partition is kept as a column of its own beside the data, so that types and nulls of the
values do not pass through folder names. It is either the text of the partition columns' values,
or, for tables without natural partitions, a bucket of the key's hash. The rewriting is Spark's
partition overwrite.

A replacement can be recovered. Its rows are written beside the table first, and an empty file
marks them as pending:

    <zone>/_pending/<table>/<id>/data/partition_of=.../      the new partitions
    <zone>/_pending/<table>/<id>/READY-<kind>-<layout>       they are complete
    <zone>/_layout/<table>/<layout>                          how the table is partitioned

Only then the table's own partitions are overwritten, and the pending copy goes last. Until then
``read`` takes what is pending from there, so a job that stops between deleting and writing hides
no row, and the next writer finishes its work. Copies that were never marked are dropped. One
writer per table at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import quote, unquote
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.upsert import BROADCAST_LIMIT, SourceProfile, profile_source, upsert
from medallion.sources import files
from medallion.sources.lake import ParquetTable
from medallion.sources.schemas import cast_to, reconciled

PART = "partition_of"
REPLACE, PARTS = "replace", "parts"
#: Partitions that one merge may touch: their names are listed on the driver and in a filter.
MOST_PARTS = 10_000


@dataclass(frozen=True)
class Pending:
    """A replacement that is complete beside the table and not yet in it."""

    home: str
    kind: str
    layout: str

    @property
    def data(self) -> str:
        return f"{self.home}/data"


@dataclass(frozen=True)
class PartitionedTable:
    """A table in partitions by ``columns``, or in ``buckets`` by the hash of ``key``."""

    spark: SparkSession
    path: str
    columns: tuple[str, ...] = ()
    buckets: int = 0
    key: str = "key"

    def __post_init__(self) -> None:
        if bool(self.columns) == bool(self.buckets):
            raise ValueError(f"{self.path}: partitions need either columns or buckets")

    @property
    def layout(self) -> str:
        return f"{self.buckets} of {self.key}" if self.buckets else ",".join(self.columns)

    def _beside(self, folder: str) -> str:
        zone, _, name = self.path.rstrip("/").rpartition("/")
        return f"{zone}/{folder}/{name}"

    def stored_layout(self) -> str | None:
        """How the table's partitions were made, if it has some."""
        found = files.entries(self.spark, self._beside("_layout"))
        return unquote(found[0].name) if found else None

    def pending(self) -> Pending | None:
        base = self._beside("_pending")
        for marker in files.matching(self.spark, f"{base}/*/READY-*"):
            home, _, name = marker.rpartition("/")
            _, kind, layout = name.split("-", 2)
            return Pending(home, kind, unquote(layout))
        return None

    def recover(self) -> None:
        """Finish a replacement that was complete when its job stopped, drop one that was not.
        For the table's only writer."""
        found = self.pending()
        if found is not None:
            self._apply(found)
        base = self._beside("_pending")
        for entry in files.entries(self.spark, base):
            files.delete(self.spark, f"{base}/{entry.name}")

    def exists(self) -> bool:
        found = self.pending()
        if found is not None and self._parts_in(found.data):
            return True
        return any(e.name[0] not in "._" for e in files.entries(self.spark, self.path))

    def read(
        self, schema: T.StructType | str | None = None, all_columns: bool = True
    ) -> DataFrame:
        """All rows, with the columns of any file."""
        return self._stored().drop(PART)

    def _parts_in(self, path: str) -> list[str]:
        prefix = f"{PART}="
        names = [e.name for e in files.entries(self.spark, path) if e.name.startswith(prefix)]
        return [unquote(name[len(prefix) :]) for name in names]

    def _stored(self) -> DataFrame:
        """All rows with their partitions, as they are once nothing is pending."""
        reader = self.spark.read.option("mergeSchema", "true")
        found = self.pending()
        if found is None:
            return reader.parquet(self.path)
        replaced = self._parts_in(found.data)
        rest = found.kind == PARTS and set(self._parts_in(self.path)) - set(replaced)
        if not rest:
            return reader.parquet(found.data)
        kept = reader.parquet(self.path).filter(~F.col(PART).isin(replaced))
        return kept.unionByName(reader.parquet(found.data), allowMissingColumns=True)

    def _part(self) -> Column:
        if self.buckets:
            bucket = F.pmod(F.xxhash64(F.col(f"`{self.key}`")), F.lit(self.buckets))
            # rows without a key match nothing and are never rewritten with others
            return F.when(F.col(f"`{self.key}`").isNull(), "n").otherwise(
                F.concat(F.lit("b"), bucket.cast("string"))
            )
        values = [F.concat(F.lit("v"), F.col(f"`{c}`").cast("string")) for c in self.columns]
        return F.concat_ws("|", *[F.coalesce(v, F.lit("n")) for v in values])

    def parts(self, df: DataFrame) -> list[str]:
        """Partitions that have rows of ``df``: the driver sees their names."""
        found = df.select(self._part()).distinct().limit(MOST_PARTS + 1).collect()
        if len(found) > MOST_PARTS:
            raise ValueError(
                f"{self.path}: more than {MOST_PARTS} partitions at once; "
                f"{self.layout} divides the table too finely"
            )
        return [row[0] for row in found]

    def read_parts(self, parts: Sequence[str], stored: DataFrame | None = None) -> DataFrame:
        """The rows of some partitions; the others are not scanned."""
        stored = self._stored() if stored is None else stored
        return stored.filter(F.col(PART).isin(*parts)).drop(PART)

    def write_parts(self, df: DataFrame) -> None:
        """Replace the partitions that have rows of ``df``, which may be derived from them."""
        self._commit(df, PARTS)

    def replace(self, df: DataFrame) -> None:
        """Make ``df`` the whole content. It may be derived from this table."""
        self._commit(df, REPLACE)

    def _commit(self, df: DataFrame, kind: str) -> None:
        before = self.pending()
        home = f"{self._beside('_pending')}/{uuid4().hex}"
        new = Pending(home, kind, self.layout)
        df.withColumn(PART, self._part()).write.partitionBy(PART).parquet(new.data)
        if before is not None:  # what ``df`` may have been read from
            self._apply(before)
        files.create_empty(self.spark, f"{home}/READY-{kind}-{quote(self.layout, safe='')}")
        self._apply(new)

    def _apply(self, found: Pending) -> None:
        """Overwrite what ``found`` replaces. Doing it again leads to the same."""
        if self._parts_in(found.data):
            # folder names, and so partitions, are taken as they are
            rows = self.spark.read.option("mergeSchema", "true").parquet(found.data)
            mode = "static" if found.kind == REPLACE else "dynamic"
            writer = rows.write.partitionBy(PART).mode("overwrite")
            writer.option("partitionOverwriteMode", mode).parquet(self.path)
        elif found.kind == REPLACE:
            files.delete(self.spark, self.path)
        marks = self._beside("_layout")
        if self.stored_layout() != found.layout:
            files.delete(self.spark, marks)
            files.create_empty(self.spark, f"{marks}/{quote(found.layout, safe='')}")
        files.delete(self.spark, found.home)

    def settle(self) -> None:
        """Recover, then bring a table that has another layout, or none, into this one. All its
        rows are written beside it before it is touched. For the table's only writer."""
        self.recover()
        whole = ParquetTable(self.spark, self.path)
        if whole.versions():
            self.replace(whole.read(all_columns=True))
        elif self.exists() and self.stored_layout() != self.layout:
            parts = self._parts_in(self.path)
            self.replace(self.read() if parts else whole.read(all_columns=True))

    def dissolve(self) -> None:
        """Make a table without partitions of this path, if it has any. For the only writer."""
        self.recover()
        if self.stored_layout() is None:
            return
        if self.exists():
            ParquetTable(self.spark, self.path).replace(self.read())
        files.delete(self.spark, self._beside("_layout"))

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
        """Upsert ``source``, which has the partition columns among its key, so that a key
        never changes its partition. Columns that leave, or whose type gets wider, rewrite the
        whole table."""
        profile = profile or profile_source(source, keys)
        profile.require_unique(keys)
        self.settle()
        if not self.exists():
            self.replace(source)
            return
        stored = self._stored()
        kept = stored.drop(PART, *drop)
        wanted = reconciled(kept.schema, source.schema, self.path)
        types = {f.name: f.dataType for f in wanted}
        if len(kept.columns) < len(stored.columns) - 1 or any(
            types[f.name] != f.dataType for f in kept.schema
        ):
            self.replace(cast_to(kept, [f for f in wanted if f.name in kept.columns]))
            stored = self._stored()
        source = cast_to(source, [f for f in wanted if f.name not in drop])
        lake = cast_to(self.read_parts(self.parts(source), stored), source.schema)
        self.write_parts(
            upsert(lake, source, keys, newer_than, profile, broadcast_limit, order, unique, same)
        )

    def expire(self, hours: float = 0) -> list[str]:
        """Nothing is kept that could expire."""
        return []
