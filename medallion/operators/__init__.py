"""DataFrame-to-DataFrame operators."""

from medallion.operators.checkpoints import checkpoint_rows, last_value, lookup, to_state
from medallion.operators.columns import drop_restricted
from medallion.operators.dedup import exact_distinct, latest_per_key, one_per_key
from medallion.operators.envelope import (
    accepted,
    build_envelope,
    envelope_schema,
    flatten,
    parse_envelope,
    rejected,
)
from medallion.operators.incremental import largest, rows_after, rows_since
from medallion.operators.upsert import SourceProfile, profile_source, upsert
from medallion.operators.wordcount import count_words

__all__ = [
    "SourceProfile",
    "accepted",
    "build_envelope",
    "checkpoint_rows",
    "count_words",
    "drop_restricted",
    "envelope_schema",
    "exact_distinct",
    "flatten",
    "largest",
    "last_value",
    "latest_per_key",
    "lookup",
    "one_per_key",
    "parse_envelope",
    "profile_source",
    "rejected",
    "rows_after",
    "rows_since",
    "to_state",
    "upsert",
]
