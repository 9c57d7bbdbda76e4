"""All tables of a configuration: ingest, then refine."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame

from medallion.plans.ingest import ingest_table
from medallion.plans.refine import refine, refine_new
from medallion.plans.spec import TableSpec
from medallion.plans.state import CheckpointState, RefinedState
from medallion.sources.lake import Lake
from medallion.sources.tables import TableSource
from medallion.streaming.ingest import drain_to_raw


@dataclass(frozen=True)
class TableRun:
    spec: TableSpec
    error: Exception | None = None


def run_tables(
    lake: Lake,
    specs: Sequence[TableSpec],
    state: CheckpointState,
    source: Callable[[TableSpec], TableSource],
    messages: Callable[[TableSpec], DataFrame],
    stream_checkpoints: str,
    load_at: datetime | None = None,
    at_once: int = 1,
    refined: RefinedState | None = None,
    files_per_batch: int | None = None,
) -> list[TableRun]:
    """Per table: drain its topic if it has one, else read its database, then
    refine. Tables are independent: one that fails is reported in its result
    and does not stop the others. ``at_once`` tables run side by side, so that
    small ones do not leave a cluster idle. With ``refined``, tables that merge
    by a checkpoint column refine their new batches only."""

    def run(spec: TableSpec) -> TableRun:
        try:
            if spec.topic:
                drain_to_raw(
                    messages(spec),
                    lake.table("raw", spec.namespace, spec.dataset, spec.storage_format),
                    spec.schema,
                    f"{stream_checkpoints}/{spec.namespace}/{spec.dataset}",
                    files_per_batch,
                )
            else:
                ingest_table(lake, source(spec), spec, state)
            in_batches = (spec.storage_format or lake.storage_format) == "parquet"
            by_time = spec.merge and spec.checkpoint_column not in (None, *spec.ignore_columns)
            if refined is not None and in_batches and by_time:
                refine_new(lake, spec, refined, load_at)
            else:
                refine(lake, spec, load_at)
            return TableRun(spec)
        except Exception as error:  # noqa: BLE001 - handed to the caller
            return TableRun(spec, error)

    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(run, specs))
