"""Upsert of a refined increment into a target, as a DataFrame plan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Above this many estimated bytes the source keys are shuffled, not broadcast.
BROADCAST_LIMIT = 64 * 1024 * 1024
ROW_OVERHEAD = 96
#: Types whose values take a few bytes each.
BOUNDED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


@dataclass(frozen=True)
class SourceProfile:
    """What one aggregate over the source keys tells about an upsert."""

    rows: int
    null_key_rows: int
    most_rows_per_key: int
    key_bytes: int

    @classmethod
    def of_known(cls, keys: Sequence[str]) -> SourceProfile:
        """For a source whose distinct keys the driver made up itself."""
        size = sum(len(k.encode()) + ROW_OVERHEAD for k in keys)
        return cls(rows=len(keys), null_key_rows=0, most_rows_per_key=1, key_bytes=size)

    def require_unique(self, keys: Sequence[str]) -> None:
        if self.most_rows_per_key > 1:
            raise ValueError(
                f"source repeats a key {list(keys)} up to {self.most_rows_per_key} times; "
                "keep one row per key first"
            )


def profile_source(source: DataFrame, keys: Sequence[str]) -> SourceProfile:
    """Count rows, null keys, repeats and key bytes in one pass over the key
    columns. Repeats are summed within partitions before the shuffle."""
    present = _all_present(keys)
    key_size = sum(F.octet_length(F.col(k).cast("string")) for k in keys) + F.lit(ROW_OVERHEAD)
    row = (
        source.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("__n"))
        .agg(
            F.sum("__n").alias("rows"),
            F.sum(F.when(~present, F.col("__n"))).alias("null_key_rows"),
            F.max(F.when(present, F.col("__n"))).alias("most"),
            F.sum(F.when(present, key_size)).alias("key_bytes"),
        )
        .first()
    )
    return SourceProfile(
        rows=row["rows"] or 0,
        null_key_rows=row["null_key_rows"] or 0,
        most_rows_per_key=row["most"] or 0,
        key_bytes=row["key_bytes"] or 0,
    )


def upsert(
    lake: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    newer_than: str | None = None,
    profile: SourceProfile | None = None,
    broadcast_limit: int = BROADCAST_LIMIT,
    order: Sequence[str] = (),
    unique: bool = False,
    same: Sequence[str] = (),
) -> DataFrame:
    """Update matched rows in all columns, insert the rest of ``source``, keep
    the rest of ``lake``. Null keys never match, so both sides keep theirs.

    The result has the columns of ``lake``: extra source columns are ignored and
    a missing one is an error. ``newer_than`` names a column that stops an older
    source row from replacing a newer one; ``order`` names several, compared one
    after the other.

    ``source`` must hold each key once; that is checked, by its ``profile`` or by
    a pass over its keys, which also picks the join. Keys within
    ``broadcast_limit`` bytes are broadcast, and the target is not shuffled at
    all. Beyond it both sides are shuffled by key; rows without a key bypass the
    shuffle, and a key that the target repeats often is split by adaptive skew
    handling. If the target holds each key once as well (``unique``), a shuffled
    comparison takes one join instead of three scans of the target.

    ``same`` names columns in which rows of one key must agree on both sides. A
    key that stands for other values stops the job, from inside the join; of
    the source only a hash of these columns goes along.
    """
    keys = list(keys)
    source = source.select(*[F.col(f"`{c}`") for c in lake.columns])
    compared = list(order) or ([newer_than] if newer_than else [])
    rank = F.struct(*[F.col(f"`{c}`") for c in compared]) if compared else None
    match = source.filter(_all_present(keys)).select(
        *[F.col(f"`{c}`").alias(f"__s_{c}") for c in keys],
        *([rank.alias("__offered")] if compared else []),
        *([_meaning(same).alias("__meant")] if same else []),
    )
    same_key = _and([F.col(k) == F.col(f"__s_{k}") for k in keys])
    if same:
        same_key = same_key & _agrees(keys, _meaning(same))

    profile = profile or profile_source(source, keys)
    profile.require_unique(keys)
    # The profile measures keys; a compared value could be of any length.
    bounded = all(isinstance(source.schema[c].dataType, BOUNDED) for c in compared)
    how = "broadcast" if bounded and profile.key_bytes <= broadcast_limit else "merge"

    if not compared:
        return _without(lake, match, same_key, keys, how).unionByName(source)
    if unique and how == "merge":
        return _newest(lake, source, keys, rank, same)
    replaced = same_key & ~(rank > F.col("__offered"))
    fresh = _not_stale(lake, source, match, keys, rank, how, same)
    return _without(lake, match, replaced, keys, how).unionByName(fresh)


def _meaning(columns: Sequence[str]) -> Column:
    """A hash of the columns' text, with nulls apart from everything else."""
    texts = [F.col(f"`{c}`").cast("string") for c in columns]
    return F.xxhash64(*[part for t in texts for part in (t, t.isNull())])


def _agrees(keys: Sequence[str], meaning: Column) -> Column:
    """True, or the end of the job."""
    shown = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    failure = F.raise_error(F.concat(F.lit("key "), shown, F.lit(" stands for different values")))
    return F.when(meaning == F.col("__meant"), F.lit(True)).otherwise(failure.cast("boolean"))


def _newest(
    lake: DataFrame, source: DataFrame, keys: list[str], rank: Column, same: Sequence[str]
) -> DataFrame:
    """Of each key's two rows the one of greater rank, the source's if they are equal. Rows
    without a key stay out of the join."""
    present = _all_present(keys)
    whole = F.struct(*[F.col(f"`{c}`") for c in lake.columns])
    meaning = _meaning(same) if same else F.lit(0)
    old = lake.filter(present).select(
        *[F.col(k).alias(f"__l_{k}") for k in keys],
        whole.alias("__old"),
        rank.alias("__stored"),
        meaning.alias("__means"),
    )
    new = source.filter(present).select(
        *[F.col(k).alias(f"__s_{k}") for k in keys],
        whole.alias("__new"),
        rank.alias("__offered"),
        meaning.alias("__meant"),
    )
    same_key = _and([F.col(f"__l_{k}") == F.col(f"__s_{k}") for k in keys])
    if same:
        same_key = same_key & _agrees([f"__l_{k}" for k in keys], F.col("__means"))
    both = old.join(new.hint("merge"), same_key, "full_outer")
    stays = F.col("__new").isNull() | F.coalesce(F.col("__stored") > F.col("__offered"), F.lit(False))
    chosen = both.select(F.when(stays, F.col("__old")).otherwise(F.col("__new")).alias("row"))
    keyless = lake.filter(~present).unionByName(source.filter(~present))
    return chosen.select("row.*").unionByName(keyless)


def _not_stale(
    lake: DataFrame,
    source: DataFrame,
    match: DataFrame,
    keys: list[str],
    rank: Column,
    how: str,
    same: Sequence[str],
) -> DataFrame:
    """Source rows that the target has nothing newer for. The target is reduced
    to one value per key within partitions before it is shuffled. Ranks are
    structs, in which a null comes before all values."""
    stored = lake.filter(_all_present(keys)).select(
        *keys, rank.alias("__rank"), *([_meaning(same).alias("__means")] if same else [])
    )
    if how == "broadcast":
        # Leaves at most one value per source key, so within the same bound.
        same_key = _and([F.col(k) == F.col(f"__s_{k}") for k in keys])
        if same:
            same_key = same_key & _agrees(keys, F.col("__means"))
        stored = stored.join(F.broadcast(match), same_key, "left_semi")
    newest = (
        stored.groupBy(*keys)
        .agg(F.max("__rank").alias("__newest"))
        .withColumnsRenamed({k: f"__l_{k}" for k in keys})
    )
    same_key = _and([F.col(k) == F.col(f"__l_{k}") for k in keys])
    stale = same_key & (F.col("__newest") > rank)
    return _without(source, newest, stale, keys, how)


def _without(
    left: DataFrame, right: DataFrame, on: Column, keys: Sequence[str], how: str
) -> DataFrame:
    """Anti join. Unless ``right`` is broadcast, rows without a key skip it: they
    match nothing, and a shuffle would put them all into one partition."""
    right = right.hint(how)
    if how == "broadcast" or not any(left.schema[k].nullable for k in keys):
        return left.join(right, on, "left_anti")
    present = _all_present(keys)
    return left.filter(present).join(right, on, "left_anti").unionByName(left.filter(~present))


def _all_present(keys: Sequence[str]) -> Column:
    return _and([F.col(k).isNotNull() for k in keys])


def _and(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts)
