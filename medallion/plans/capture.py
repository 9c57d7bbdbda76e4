"""Table to change events."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from medallion.operators.envelope import build_envelope
from medallion.operators.incremental import rows_after
from medallion.plans.state import KeysetState
from medallion.sources.scratch import staged
from medallion.sources.tables import TableSource

BROADCAST_IDS = 1_000_000


@dataclass(frozen=True)
class Captured:
    table: str
    rows: int
    last_id: int | None
    error: Exception | None = None


def capture_table(
    source: TableSource,
    database: str,
    table: str,
    state: KeysetState,
    publish: Callable[[DataFrame], None],
    id_column: str = "id",
    ts_ms: int | None = None,
) -> Captured:
    """Publish one insert event per row with an id above the last processed one,
    at first per row with an id, then store the greatest id published. ``publish`` gets a frame with one
    ``value`` column and must write all of it.

    With an overlap in ``state``, rows with an id in that window below the last one
    are published too if they have not been yet: ids that were committed after
    larger ones. Ids are unique then. Those later than the window are left out.
    """
    stamp = int(time.time() * 1000) if ts_ms is None else ts_ms
    if state.overlap:
        return _capture_window(source, database, table, state, publish, id_column, stamp)
    rows = rows_after(source.table(table), id_column, state.value(table))
    seen = _publish(rows, database, table, publish, id_column, stamp)
    if seen["last"] is not None:
        state.save(table, seen["last"])
    return Captured(table, seen["rows"], seen["last"])


def _publish(
    rows: DataFrame,
    database: str,
    table: str,
    publish: Callable[[DataFrame], None],
    id_column: str,
    stamp: int,
) -> dict:
    seen = Observation()
    observed = rows.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.max(id_column).alias("last")
    )
    publish(observed.select(build_envelope(rows, database, table, stamp).alias("value")))
    return seen.get


def _capture_window(
    source: TableSource,
    database: str,
    table: str,
    state: KeysetState,
    publish: Callable[[DataFrame], None],
    id_column: str,
    stamp: int,
) -> Captured:
    """The rows are stored once: the source may have others when it is read again."""
    last = state.value(table)
    ids = F.col(f"`{id_column}`").cast("long").alias("id")
    rows = rows_after(source.table(table), id_column, None if last is None else last - state.overlap)
    known = state.published(table)
    if known is None and last is not None:
        # polls without a window have published what is up to the last id now
        known = rows.where(F.col(f"`{id_column}`") <= last).select(ids)
    if known is None:
        known = rows.limit(0).select(ids)
    with staged(rows.sparkSession, known, f"{table}-known") as known:
        # the window has as many ids at most
        match = F.broadcast(known) if state.overlap <= BROADCAST_IDS else known
        late = rows.join(match, rows[id_column] == match["id"], "left_anti")
        with staged(rows.sparkSession, late, table) as fresh:
            seen = _publish(fresh, database, table, publish, id_column, stamp)
            if seen["last"] is not None:
                last = seen["last"] if last is None else max(last, seen["last"])
            if last is not None:
                state.save(table, last, known.union(fresh.select(ids)))
    return Captured(table, seen["rows"], seen["last"])


def capture_all(
    source: TableSource,
    database: str,
    tables: Sequence[str],
    state: KeysetState,
    publish: Callable[[str, DataFrame], None],
    id_columns: dict[str, str] | None = None,
    at_once: int = 4,
) -> list[Captured]:
    """Capture each table once, ``at_once`` side by side. A table that fails is reported in its
    result and does not stop the others; its position does not move."""

    def capture(table: str) -> Captured:
        try:
            return capture_table(
                source,
                database,
                table,
                state,
                lambda messages: publish(table, messages),
                (id_columns or {}).get(table, "id"),
            )
        except Exception as error:  # noqa: BLE001 - handed to the caller
            return Captured(table, 0, None, error)

    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(capture, tables))
