"""Positions of messages: which offsets of a topic a raw table holds.

A batch that is read again by another stream, or after its progress was lost, brings offsets that
raw has already. The ranges stored with each batch tell them apart without a look at raw itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medallion.sources.lake import ParquetTable
from medallion.sources.messages import POSITION

#: A message's position in raw, beside the columns of its envelope.
RAW_POSITION = tuple(f"message_{name}" for name in POSITION)
RANGES_SCHEMA = "topic string, partition int, first bigint, last bigint, batch string"


def ranges_of(rows: DataFrame, batch: str) -> DataFrame:
    """A row per topic partition of a raw batch: its least and its greatest offset."""
    topic, partition, offset = RAW_POSITION
    return (
        rows.where(F.col(offset).isNotNull())
        .groupBy(F.col(topic).alias("topic"), F.col(partition).cast("int").alias("partition"))
        .agg(F.min(offset).cast("bigint").alias("first"), F.max(offset).cast("bigint").alias("last"))
        .withColumn("batch", F.lit(batch))
    )


def folded(ranges: DataFrame) -> DataFrame:
    """Ranges of a topic partition that overlap or follow one another as one."""
    order = Window.partitionBy("topic", "partition").orderBy("first", "last")
    before = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.coalesce(F.col("first") > before + 1, F.lit(True)).cast("int")
    island = F.sum("starts").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        ranges.withColumn("starts", starts)
        .withColumn("island", island)
        .groupBy("topic", "partition", "island")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
        .drop("island")
    )


@dataclass(frozen=True)
class Offsets:
    """Ranges of offsets per raw batch, in a table of their own."""

    table: ParquetTable

    def fresh(self, messages: DataFrame, batch: str) -> DataFrame:
        """Messages whose offsets no other batch holds; a batch that comes again keeps its own."""
        if not self.table.exists():
            return messages
        held = folded(self.table.read(RANGES_SCHEMA).where(F.col("batch") != batch))
        held = F.broadcast(held.toDF(*[f"__{c}" for c in held.columns]))  # some per topic partition
        topic, partition, offset = (F.col(c) for c in POSITION)
        within = offset.between(F.col("__first"), F.col("__last"))
        same = (topic == F.col("__topic")) & (partition == F.col("__partition"))
        return messages.join(held, same & within, "left_anti")

    def add(self, rows: DataFrame, batch: str) -> None:
        """Store the ranges of a batch that raw has; a repeated one replaces them in effect."""
        self.table.append(ranges_of(rows, batch).coalesce(1))
