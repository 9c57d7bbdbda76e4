"""The jobs a user calls."""

from medallion.plans.capture import capture_all, capture_table
from medallion.plans.ingest import ingest_table
from medallion.plans.refine import (
    read_quarantine,
    read_raw,
    refine,
    refine_frame,
    refine_new,
)
from medallion.plans.run import run_tables
from medallion.plans.spec import TableSpec, specs_from_config
from medallion.plans.state import CheckpointState, KeysetState, RefinedState

__all__ = [
    "CheckpointState",
    "KeysetState",
    "RefinedState",
    "TableSpec",
    "capture_all",
    "capture_table",
    "ingest_table",
    "read_quarantine",
    "read_raw",
    "refine",
    "refine_frame",
    "refine_new",
    "run_tables",
    "specs_from_config",
]
