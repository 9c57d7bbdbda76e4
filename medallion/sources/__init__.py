"""Where rows come from and go to: lake zones, databases, message topics."""

from medallion.sources.lake import DeltaTable, Lake, ParquetTable
from medallion.sources.messages import (
    kafka_messages,
    text_messages,
    write_kafka,
    write_text,
)
from medallion.sources.scratch import new_scratch, staged
from medallion.sources.tables import CatalogSource, JdbcSource

__all__ = [
    "CatalogSource",
    "DeltaTable",
    "JdbcSource",
    "Lake",
    "ParquetTable",
    "kafka_messages",
    "new_scratch",
    "staged",
    "text_messages",
    "write_kafka",
    "write_text",
]
