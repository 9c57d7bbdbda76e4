"""Database table to raw zone."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any
from uuid import uuid4

from pyspark.sql import Observation
from pyspark.sql import functions as F

from medallion.operators.checkpoints import checkpoint_type, encoded
from medallion.operators.incremental import rows_since
from medallion.plans.spec import TableSpec
from medallion.plans.state import CheckpointState
from medallion.sources.lake import Lake
from medallion.sources.tables import TableSource


@dataclass(frozen=True)
class Ingested:
    rows: int
    last_value: Any | None


def ingest_table(
    lake: Lake,
    source: TableSource,
    spec: TableSpec,
    state: CheckpointState,
    run_id: str | None = None,
) -> Ingested:
    """Append the rows at or after the stored checkpoint to raw, then advance it.

    The new checkpoint is observed while the rows are written, so the source is
    read once and the value never covers a row that was not written. No rows
    leave the checkpoint as it is. A custom query replaces the checkpoint
    predicate and leaves the checkpoint alone. Rows may come twice after a
    failure between the two steps; refinement removes the repeats.

    A run that is repeated under its ``run_id`` does nothing if its checkpoint
    was saved. If not, it reads from the old checkpoint again; rows that it has
    written completely stay, and what it reads now goes to a batch beside them.
    """
    column = None if spec.custom_query else spec.checkpoint_column
    run_id = run_id or uuid4().hex
    raw = lake.table("raw", spec.namespace, spec.dataset, spec.storage_format)
    batch, kind = 0, None
    if spec.custom_query:
        rows = source.query(spec.custom_query, spec.dataset)
    else:
        rows = source.table(spec.dataset)
    if column:
        entry = state.entry(spec.namespace, spec.dataset)
        if entry is not None and entry.run_id == run_id:
            return Ingested(0, state.value(spec.namespace, spec.dataset))
        kind = checkpoint_type(rows, column)
        rows = rows_since(rows, column, state.bound(entry, kind))
        batch = raw.next_batch(run_id)

    written = Observation()
    metrics = [F.count(F.lit(1)).alias("rows")]
    if column:
        greatest = F.max(column)
        metrics += [greatest.alias("last"), encoded(greatest, kind).alias("text")]
    raw.add_batch(rows.observe(written, *metrics), run_id, batch)

    seen = written.get
    if column and seen["text"] is not None:
        state.save(spec.namespace, spec.dataset, column, kind, seen["text"], run_id)
    return Ingested(seen["rows"], seen.get("last"))
