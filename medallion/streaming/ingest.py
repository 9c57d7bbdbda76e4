"""Change stream to raw zone."""

from __future__ import annotations

from concurrent.futures import Future

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from medallion.operators.envelope import REJECTED, parse_envelope
from medallion.sources.lake import DeltaTable, ParquetTable
from medallion.sources.messages import POSITION
from medallion.streaming.positions import RAW_POSITION, Offsets


def drain_to_raw(
    messages: DataFrame,
    raw: ParquetTable | DeltaTable,
    schema: T.StructType | str,
    checkpoint_location: str,
    files_per_batch: int | None = None,
    offsets: Offsets | None = None,
) -> StreamingQuery:
    """Parse and append all messages that are waiting, then stop.

    The next call with the same ``checkpoint_location`` goes on after them. A
    batch that runs again after a failure replaces itself: it is stored under
    the stream's id, which lives in the checkpoint, and the batch number.
    Messages that do not parse are stored too, see ``parse_envelope``.
    ``files_per_batch`` joins what many small input splits give; they are parsed
    side by side before that. Messages that have a position keep it in raw; with
    ``offsets``, those that raw holds already, from whichever stream, stay out.
    """
    stream_id: Future[str] = Future()

    def land(batch: DataFrame, batch_id: int) -> None:
        land_messages(batch, raw, schema, stream_id.result(), batch_id, files_per_batch, offsets)

    query = (
        messages.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint_location)
        .trigger(availableNow=True)
        .start()
    )
    stream_id.set_result(query.id)
    query.awaitTermination()
    return query


def land_messages(
    messages: DataFrame,
    raw: ParquetTable | DeltaTable,
    schema: T.StructType | str,
    run_id: str,
    batch_id: int,
    files_per_batch: int | None = None,
    offsets: Offsets | None = None,
) -> None:
    """Parse one batch of messages and store it under ``run_id`` and ``batch_id``."""
    has_position = set(POSITION) <= set(messages.columns)
    if offsets is not None and not has_position:
        raise ValueError("messages have no position to compare")
    name = f"run-{run_id}/batch-{batch_id}"
    if offsets is not None:
        messages = offsets.fresh(messages, name)
    carry = [F.col(c).alias(r) for c, r in zip(POSITION, RAW_POSITION, strict=True)]
    rows = parse_envelope(messages, schema, carry=carry if has_position else ())
    if files_per_batch is not None:
        rows = rows.repartition(files_per_batch)
    raw.add_batch(rows, run_id, batch_id)
    if offsets is not None:
        offsets.add(raw.spark.read.parquet(f"{raw.current_path()}/{name}"), name)


def parse_again(
    raw: ParquetTable, schema: T.StructType | str, run_id: str = "again"
) -> int:
    """Give the rejected messages of all batches a second chance under a corrected ``schema``.

    Those that parse now become a batch of their own, with the position they had; doing it again
    under the same ``run_id`` replaces that batch. Returns how many there are. The batches they
    were rejected in stay as they are.
    """
    batches = [b for b in raw.complete_batches() if not b.startswith(f"run-{run_id}/")]
    if not batches:
        return 0
    root = raw.current_path()
    files_ = raw.spark.read.option("mergeSchema", "true").parquet(*[f"{root}/{b}" for b in batches])
    kept = [c for c in RAW_POSITION if c in files_.columns]
    again = parse_envelope(
        files_.where(F.col(REJECTED).isNotNull()).select(REJECTED, *kept),
        schema,
        REJECTED,
        [F.col(c) for c in kept],
    )
    seen = Observation()
    good = again.where(F.col(REJECTED).isNull()).observe(seen, F.count(F.lit(1)).alias("rows"))
    raw.add_batch(good, run_id, 0)
    return seen.get["rows"]
