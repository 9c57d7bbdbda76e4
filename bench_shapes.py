"""Compare a job's shape here with the shape of a job that handles one message
at a time, or one join strategy with another. Prints rows per second."""

from __future__ import annotations

import os
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from bench import session
from catalog.registry import TS_MS, new_lake, table
from medallion.operators import build_envelope, parse_envelope, profile_source, upsert
from medallion.plans import TableSpec, refine
from medallion.sources import new_scratch, text_messages, write_text
from medallion.streaming import drain_to_raw

SINGLE_MESSAGES = 40


def report(name: str, rows: int, seconds: float) -> None:
    print(f"{name:42} {rows:>9,} rows {seconds:8.2f} s {rows / seconds:>12,.0f} rows/s", flush=True)


def clock(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    with tempfile.TemporaryDirectory(prefix="bench-") as shared:
        spark = session(os.environ.get("BENCH_CPUS", str(os.cpu_count())), shared)
        compare(spark, os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"))
        spark.stop()


def compare(spark: SparkSession, sf_dir: str) -> None:
    events = table(spark, sf_dir, "events")
    count = events.count()

    messages = events.select(build_envelope(events, "lake", "events", TS_MS).alias("value"))
    topic = new_scratch(spark, "topic")
    write_text(messages, topic)
    for attempt in ("cold", "warm"):
        raw = new_lake(spark).table("raw", "shop", "events")
        progress = new_scratch(spark, "progress")
        stream = text_messages(spark, topic)
        seconds = clock(lambda: drain_to_raw(stream, raw, events.schema, progress))
        report(f"events to raw, micro-batches ({attempt})", count, seconds)

    texts = [r.value for r in messages.limit(SINGLE_MESSAGES).collect()]
    raw = new_lake(spark).table("raw", "shop", "events")

    def one_by_one():
        for text in texts:
            message = spark.createDataFrame([(text,)], "value string")
            raw.append(parse_envelope(message, events.schema))

    report("events to raw, one write per message", len(texts), clock(one_by_one))

    lines = table(spark, sf_dir, "lineitem")
    rows = lines.count()
    spec = TableSpec(
        "shop",
        "lineitem",
        ("l_orderkey", "l_linenumber"),
        checkpoint_column="l_shipdate",
        ignore_columns=("l_tax",),
        separator=True,
        merge=True,
    )
    lake = new_lake(spark)
    lake.write(lines.repartition(8), "raw", "shop", "lineitem")
    report("refine, first load of both zones", rows, clock(lambda: refine(lake, spec)))
    report("refine, merge into both zones", rows, clock(lambda: refine(lake, spec)))

    target = lake.read("trusted", "shop", "lineitem").drop("timestamp_kafka")
    few = target.filter(F.col("l_shipdate") >= F.lit("2001-10-01").cast("timestamp_ntz"))
    profile = profile_source(few, ["key"])
    for name, limit in (("broadcast keys", 1 << 30), ("shuffled", 0), ("broadcast keys", 1 << 30)):
        plan = upsert(target, few, ["key"], profile=profile, broadcast_limit=limit)
        seconds = clock(lambda: plan.write.format("noop").mode("overwrite").save())
        report(f"upsert of {profile.rows:,} rows, {name}", target.count(), seconds)


if __name__ == "__main__":
    main()
