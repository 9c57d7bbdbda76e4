"""Column expressions."""

from medallion.functions.dates import guard_dates, load_instant, with_load_timestamp
from medallion.functions.keys import checkpoint_key, surrogate_key
from medallion.functions.text import words

__all__ = [
    "checkpoint_key",
    "guard_dates",
    "load_instant",
    "surrogate_key",
    "with_load_timestamp",
    "words",
]
