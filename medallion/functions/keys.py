"""Surrogate keys and checkpoint key names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text between key parts, name of a stored checkpoint.
SEPARATOR = "-"
CHECKPOINT_KEY = "prd_raw_{namespace}_{dataset}"


def surrogate_key(
    columns: Sequence[str], separator: bool = False, null_token: str | None = None
) -> Column:
    """MD5 over the text of ``columns``.

    With ``separator`` the parts are joined by ``-`` and nulls are skipped, so
    (a, null, b) and (a, b, null) share a key. Without it the parts are glued
    together, any null makes the key null, and ("1", "23") equals ("12", "3").
    Both collisions belong to the stored key format; ``null_token`` replaces
    nulls with a fixed text for callers who are free to choose a new format.
    """
    if not columns:
        raise ValueError("a surrogate key needs at least one column")
    parts = [F.col(c).cast("string") for c in columns]
    if null_token is not None:
        parts = [F.coalesce(p, F.lit(null_token)) for p in parts]
    return F.md5(F.concat_ws(SEPARATOR, *parts) if separator else F.concat(*parts))


def checkpoint_key(namespace: str, dataset: str) -> str:
    """Name under which a dataset's checkpoint is stored."""
    return CHECKPOINT_KEY.format(namespace=namespace, dataset=dataset)
