"""What a job has to know about one table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any, Literal

from pyspark.sql import types as T

from medallion.operators.envelope import table_schema
from medallion.sources.lake import RETENTION_HOURS


@dataclass(frozen=True)
class TableSpec:
    """One table. With a ``topic`` it is ingested from change events of the
    given ``schema``, otherwise from the database. ``merge`` upserts into the
    safe and trusted zones instead of replacing them, and then deletes what was
    replaced more than ``retention_hours`` ago. ``storage_format`` is that of
    the lake unless named. With ``partition_by``, columns of the key, or
    ``buckets`` of the hashed key, a merge rewrites only the partitions that it
    touches. ``narrower`` tells what to do with rows from the database in which
    a column has a narrower type than it had before."""

    namespace: str
    dataset: str
    table_key: tuple[str, ...]
    checkpoint_column: str | None = None
    ignore_columns: tuple[str, ...] = ()
    schema: T.StructType | None = None
    topic: str | None = None
    servers: str | None = None
    custom_query: str | None = None
    separator: bool = False
    merge: bool = False
    newer_than: str | None = None
    on_null_key: Literal["keep", "reject"] = "keep"
    tie_break: tuple[str, ...] | None = None
    retention_hours: float = RETENTION_HOURS
    storage_format: Literal["parquet", "delta"] | None = None
    partition_by: tuple[str, ...] = ()
    buckets: int = 0
    narrower: Literal["error", "widen"] = "error"

    def __post_init__(self) -> None:
        if self.topic and self.schema is None:
            raise ValueError(f"{self.dataset}: a topic needs a schema")
        if self.on_null_key not in ("keep", "reject"):
            raise ValueError(f"{self.dataset}: on_null_key must be keep or reject")
        if self.on_null_key == "reject" and not self.merge:
            raise ValueError(f"{self.dataset}: rows without a key can only be rejected by a merge")
        if not set(self.partition_by) <= set(self.table_key) - set(self.ignore_columns):
            raise ValueError(f"{self.dataset}: partitions need open columns of the key")
        if self.buckets < 0 or (self.buckets and self.partition_by):
            raise ValueError(f"{self.dataset}: partitions are by columns or by buckets of the key")
        if self.storage_format == "delta" and (self.buckets or self.partition_by):
            raise ValueError(f"{self.dataset}: a Delta table is not partitioned here")
        if self.narrower not in ("error", "widen"):
            raise ValueError(f"{self.dataset}: narrower must be error or widen")
        if self.newer_than in self.ignore_columns:
            raise ValueError(f"{self.dataset}: the trusted zone needs {self.newer_than} to compare")


def specs_from_config(config: Mapping[str, Mapping[str, Any]]) -> list[TableSpec]:
    """Specs of a configuration ``{group: {connection, tables: {name: {...}}}}``.

    Schemas are DDL text, schema JSON or ``StructType``. Sizing, owner and
    schedule entries belong to the caller's scheduler and are ignored.
    """
    specs = []
    for group in config.values():
        for name, entry in group["tables"].items():
            schema = entry.get("schema")
            specs.append(
                TableSpec(
                    namespace=group["connection"],
                    dataset=name,
                    table_key=tuple(entry["key"]),
                    checkpoint_column=entry.get("checkpoint_column"),
                    ignore_columns=tuple(entry.get("ignore_columns") or ()),
                    schema=None if schema is None else table_schema(schema),
                    topic=entry.get("topic"),
                    servers=entry.get("kafka_server"),
                    custom_query=entry.get("custom_query"),
                    separator=entry.get("enable_hyphen_separator", False),
                    merge=entry.get("delta_format", False),
                    newer_than=entry.get("newer_than"),
                    on_null_key=entry.get("on_null_key", "keep"),
                    tie_break=tuple(entry["tie_break"]) if entry.get("tie_break") else None,
                    retention_hours=entry.get("retention_hours", RETENTION_HOURS),
                    storage_format=entry.get("storage_format"),
                    partition_by=tuple(entry.get("partition_by") or ()),
                    buckets=entry.get("buckets", 0),
                    narrower=entry.get("narrower", "error"),
                )
            )
    return specs
