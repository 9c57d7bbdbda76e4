"""Change streams: messages to the raw zone, and which of them it holds."""

from medallion.streaming.ingest import drain_to_raw, land_messages, parse_again
from medallion.streaming.positions import Offsets

__all__ = ["Offsets", "drain_to_raw", "land_messages", "parse_again"]
