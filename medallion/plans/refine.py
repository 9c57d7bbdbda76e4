"""Raw zone to safe and trusted zones."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions.dates import LOAD_COLUMN, date_columns, guard_dates, with_load_timestamp
from medallion.functions.keys import surrogate_key
from medallion.operators.columns import drop_restricted
from medallion.operators.dedup import latest_per_key, one_per_key
from medallion.operators.envelope import (
    REJECTED,
    accepted,
    event_schema,
    flatten,
    parse_envelope,
    rejected,
)
from medallion.operators.upsert import profile_source
from medallion.plans.spec import TableSpec
from medallion.plans.state import RefinedState
from medallion.sources.lake import DeltaTable, Lake, ParquetTable, with_columns_of
from medallion.sources.partitioned import PartitionedTable
from medallion.sources.scratch import staged
from medallion.streaming.positions import RAW_POSITION

Zone = ParquetTable | PartitionedTable | DeltaTable

KEY = "key"
CLASH = re.compile(r"key \S+ stands for different values")


def read_raw(
    lake: Lake,
    namespace: str,
    dataset: str,
    from_events: bool,
    schema: T.StructType | None = None,
    storage_format: str | None = None,
    narrower: str = "error",
) -> DataFrame:
    """Rows of a raw table: after-images if it holds change events, else as is.

    ``schema`` are the table's columns now. Batches written before a column was
    added have null in it; without a schema the columns are those of all files.
    Database rows have the widest type that a batch was read with; a batch with
    a narrower type than those before it is an error that names it, unless
    ``narrower`` is ``"widen"``.
    """
    raw = lake.table("raw", namespace, dataset, storage_format)
    if from_events:
        events = raw.read(None if schema is None else event_schema(schema))
        return flatten(accepted(events))
    return raw.read_widened(narrower)


def read_quarantine(
    lake: Lake, namespace: str, dataset: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """Raw text of the messages that were not envelopes. With a corrected ``schema``, only of
    those that are none under it either."""
    found = rejected(lake.read("raw", namespace, dataset))
    return found if schema is None else rejected(parse_envelope(found, schema, REJECTED))


def locate_quarantine(lake: Lake, namespace: str, dataset: str) -> DataFrame:
    """The same with the ``batch`` and the position in the topic, as far as messages had one."""
    raw = lake.table("raw", namespace, dataset).read(all_columns=True)
    place = F.regexp_extract("_metadata.file_path", "(run-[^/]+/batch-[0-9]+)/[^/]+$", 1)
    kept = [c for c in RAW_POSITION if c in raw.columns]
    return raw.where(F.col(REJECTED).isNotNull()).select(place.alias("batch"), *kept, REJECTED)


def refine_frame(
    raw: DataFrame,
    table_key: Sequence[str],
    checkpoint: str | None = None,
    separator: bool = False,
    load_at: datetime | None = None,
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key, with hashed key and load timestamp, without impossible
    dates: the latest row by ``checkpoint``, or any row if there is none.

    The key is the hash of the values before the date guard. It is computed on
    the surviving rows only, unless the guard may change a key column or the
    hash itself decides which rows belong together.
    """
    keyed = surrogate_key(table_key, separator)
    if checkpoint is None:
        rows = guard_dates(one_per_key(raw.withColumn(KEY, keyed), [KEY]))
    elif set(table_key) & set(date_columns(raw)):
        rows = guard_dates(raw.withColumn(KEY, keyed))
        rows = latest_per_key(rows, table_key, checkpoint, tie_break)
    else:
        rows = latest_per_key(guard_dates(raw), table_key, checkpoint, tie_break)
        rows = rows.withColumn(KEY, keyed)
    return with_load_timestamp(rows, load_at)


def refine(lake: Lake, spec: TableSpec, load_at: datetime | None = None) -> None:
    """Refine a raw table into the trusted zone, without restricted columns, and
    with restricted columns also into the safe zone, with all of them.

    The refined rows are computed once: a trusted zone is read from the safe zone
    just written, and a merge reads a stored copy.
    """
    raw = read_raw(
        lake,
        spec.namespace,
        spec.dataset,
        spec.topic is not None,
        spec.schema,
        spec.storage_format,
        spec.narrower,
    )
    _land(lake, spec, _refined(raw, spec, load_at))


def refine_new(
    lake: Lake, spec: TableSpec, state: RefinedState, load_at: datetime | None = None
) -> list[str]:
    """Merge only the raw batches that no earlier call has refined, so that a run
    costs what has arrived and not what is stored. Returns their names.

    Rows compare with those in the target as in a full refinement, by checkpoint
    and then all other columns, so the zones hold what that would merge; rows
    that did not change keep their load timestamp. A zone that does not exist
    yet is built from all of raw. A key that stands for other values in the
    target is an error. A batch counts as refined after both zones have it.
    """
    column = spec.checkpoint_column
    if not spec.merge or not column or column in spec.ignore_columns:
        raise ValueError(f"{spec.dataset}: new batches need merge and an open checkpoint column")
    table = lake.table("raw", spec.namespace, spec.dataset, spec.storage_format)
    table.batches()  # an error where rows stand outside of batches
    batches = state.pending(table, spec.namespace, spec.dataset)
    if not batches:
        return []
    safe, trusted = _zones(lake, spec)
    if not trusted.exists() or (safe is not None and not safe.exists()):
        refine(lake, spec, load_at)
    else:
        if spec.topic is None:
            raw = table.read_batches(batches, narrower=spec.narrower)
        else:
            raw = flatten(accepted(table.read_batches(batches, event_schema(spec.schema))))
        known = (safe or trusted).read().drop(KEY, LOAD_COLUMN)
        raw = with_columns_of(raw, known)
        first = [*spec.table_key, column]
        ties = spec.tie_break
        if ties is None:
            ties = [c for c in raw.columns if c not in first]
        _land(lake, spec, _refined(raw, spec, load_at), [column, *ties])
    state.add(spec.namespace, spec.dataset, batches)
    return batches


def _refined(raw: DataFrame, spec: TableSpec, load_at: datetime | None) -> DataFrame:
    return refine_frame(
        raw, spec.table_key, spec.checkpoint_column, spec.separator, load_at, spec.tie_break
    )


def _zones(lake: Lake, spec: TableSpec):
    """The safe zone, if there is to be one or is one, and the trusted zone. A table whose
    layout is not the one of ``spec`` is brought into it first, with all its rows."""
    def zone(name: str):
        table = lake.table(name, spec.namespace, spec.dataset, spec.storage_format)
        divided = spec.partition_by or spec.buckets
        if isinstance(table, DeltaTable):
            if divided:
                raise ValueError(f"{spec.dataset}: a Delta table is not partitioned here")
            return table
        if divided:
            table = PartitionedTable(lake.spark, table.path, spec.partition_by, spec.buckets, KEY)
            table.settle()
        else:
            PartitionedTable(lake.spark, table.path, buckets=1).dissolve()
        return table

    safe = zone("safe")
    wanted = spec.ignore_columns or safe.exists()
    return (safe if wanted else None), zone("trusted")


def _land(lake: Lake, spec: TableSpec, rows: DataFrame, order: Sequence[str] = ()) -> None:
    """Bring refined rows into the zones, then delete what was replaced long enough ago, or at
    once where it shows columns that are restricted now."""
    hidden = set(spec.ignore_columns)
    safe, trusted = _zones(lake, spec)
    shown = trusted.exists() and hidden & set(trusted.read().columns)
    if spec.merge:
        _merge(spec, rows, safe, trusted, order)
    elif safe is None:
        trusted.replace(rows)
    else:
        safe.replace(rows)
        trusted.replace(drop_restricted(safe.read(), spec.ignore_columns))
    if safe is not None:
        safe.expire(spec.retention_hours)
    trusted.expire(0 if shown else spec.retention_hours)


def _merge(
    spec: TableSpec,
    rows: DataFrame,
    safe: Zone | None,
    trusted: Zone,
    order: Sequence[str],
) -> None:
    """Merge into the safe zone and take the trusted zone from it, so that the target is joined
    once; a zone that stands alone, or in front of an absent one, is merged itself."""
    hidden = spec.ignore_columns
    with staged(trusted.spark, rows, spec.dataset) as source:
        profile = profile_source(source, [KEY])
        profile.require_unique([KEY])
        if spec.on_null_key == "reject" and profile.null_key_rows:
            raise ValueError(f"{spec.dataset}: {profile.null_key_rows} rows have no key")
        options = {"profile": profile, "unique": True}
        if isinstance(trusted, DeltaTable):
            options["newer_than"] = spec.newer_than or (order[0] if order else None)
        else:
            options |= {"order": order} if order else {"newer_than": spec.newer_than}
            target = safe or trusted
            if order and target.exists():
                known = target.read().columns
                options["same"] = [c for c in spec.table_key if c in known]
        complete = safe is not None and safe.exists()
        if safe is not None:
            _checked(spec, lambda: safe.merge(source, [KEY], **options))
        if complete and trusted.exists():
            whole = drop_restricted(safe.read(), hidden)
            kinds, shown = dict(whole.dtypes), dict(trusted.read().dtypes)
            if isinstance(safe, PartitionedTable) and all(kinds.get(c) == k for c, k in shown.items()):
                touched = safe.read_parts(safe.parts(source))
                trusted.write_parts(drop_restricted(touched, hidden))
            else:
                trusted.replace(whole)
        else:
            options["same"] = [c for c in options.get("same", ()) if c not in hidden]
            shown = drop_restricted(source, hidden)
            _checked(spec, lambda: trusted.merge(shown, [KEY], drop=hidden, **options))


def _checked(spec: TableSpec, merge: Callable[[], None]) -> None:
    """Run a merge; keys that stand for different values, which its join finds, are the
    caller's error."""
    try:
        merge()
    except (PySparkException, Py4JJavaError) as error:
        clash = CLASH.search(str(error))
        if clash is None:
            raise
        raise ValueError(f"{spec.dataset}: {clash[0]}") from error
