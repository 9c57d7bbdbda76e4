"""Command line of the jobs, for ``spark-submit run_job.py <job> ...``.

Connection settings come from the caller as ``--option name=value``; master,
memory and storage credentials come from ``spark-submit``.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import SparkSession

from medallion.operators import count_words
from medallion.operators.envelope import table_schema
from medallion.plans import (
    CheckpointState,
    KeysetState,
    RefinedState,
    TableSpec,
    capture_all,
    ingest_table,
    refine,
    refine_new,
    run_tables,
    specs_from_config,
)
from medallion.sources import (
    CatalogSource,
    JdbcSource,
    Lake,
    kafka_messages,
    text_messages,
    write_kafka,
    write_text,
)
from medallion.sources.lake import RETENTION_HOURS
from medallion.sources.tables import RemainderSplit, Split
from medallion.streaming import drain_to_raw


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="run_job.py", description=__doc__)
    jobs = root.add_subparsers(dest="job", required=True)

    lake = argparse.ArgumentParser(add_help=False)
    lake.add_argument("--root", default="s3a://", help="where bucket names start")
    lake.add_argument("--environment", default="PRODUCTION", choices=["PRODUCTION", "STAGING"])
    lake.add_argument("--format", default="parquet", choices=["parquet", "delta"])

    database = argparse.ArgumentParser(add_help=False)
    database.add_argument("--url", help="JDBC URL; without it tables of the catalog are read")
    database.add_argument("--driver")
    database.add_argument(
        "--split", action="append", default=[], metavar="TABLE:COLUMN:TASKS[:remainder]"
    )
    database.add_argument("--option", action="append", default=[], metavar="NAME=VALUE")

    topic = argparse.ArgumentParser(add_help=False)
    topic.add_argument("--servers", help="Kafka servers; without them topics are folders of text")
    topic.add_argument("--topic-option", action="append", default=[], metavar="NAME=VALUE")
    topic.add_argument("--max-offsets", type=int)

    table = argparse.ArgumentParser(add_help=False)
    table.add_argument("--namespace", required=True)
    table.add_argument("--dataset", required=True)

    capture = jobs.add_parser("capture", parents=[lake, database, topic])
    capture.add_argument("--database", required=True)
    capture.add_argument("--table", action="append", required=True, metavar="TABLE[:IDCOLUMN]")
    capture.add_argument("--topic", help="default: the table's name")

    events = jobs.add_parser("ingest-events", parents=[lake, topic, table])
    events.add_argument("--topic", required=True)
    events.add_argument("--schema", required=True, help="DDL or schema JSON of the table")
    events.add_argument("--progress", required=True, help="checkpoint folder of the stream")

    rows = jobs.add_parser("ingest-table", parents=[lake, database, table])
    rows.add_argument("--checkpoint-column")
    rows.add_argument("--custom-query")

    refining = jobs.add_parser("refine", parents=[lake, table])
    refining.add_argument("--table-key", nargs="+", required=True)
    refining.add_argument("--checkpoint-column")
    refining.add_argument("--ignore-columns", nargs="*", default=[])
    refining.add_argument("--hyphen-separator", action="store_true")
    refining.add_argument("--merge", action="store_true")
    refining.add_argument("--newer-than")
    refining.add_argument("--partition-by", nargs="*", default=(), help="rewrite touched ones only")
    refining.add_argument("--only-new", action="store_true", help="merge new raw batches only")
    refining.add_argument("--retention-hours", type=float, default=RETENTION_HOURS)
    refining.add_argument("--topic", help="raw holds change events of this topic")
    refining.add_argument("--schema", help="DDL or schema JSON of the table")

    run = jobs.add_parser("run", parents=[lake, database, topic])
    run.add_argument("--config", required=True, help="JSON or YAML file")
    run.add_argument("--progress", required=True, help="checkpoint folder of the streams")
    run.add_argument("--full", action="store_true", help="refine all of raw, not new batches only")
    run.add_argument("--only-new", action="store_true", help="the default now")
    run.add_argument("--files-per-batch", type=int, help="files that a stream batch is written in")
    run.add_argument("--at-once", type=int, default=1, help="tables to run side by side")

    words = jobs.add_parser("count-words")
    words.add_argument("--input", required=True)
    words.add_argument("--output", required=True)
    return root


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = spark or SparkSession.builder.appName(f"medallion {args.job}").getOrCreate()
    JOBS[args.job](spark, args)


def _capture(spark: SparkSession, args: argparse.Namespace) -> None:
    names = dict(t.split(":", 1) if ":" in t else (t, "id") for t in args.table)

    def publish(table, messages):
        topic = args.topic or table
        if args.servers:
            write_kafka(messages, args.servers, topic, _pairs(args.topic_option))
        else:
            write_text(messages, topic)

    state = KeysetState(_lake(spark, args).table("state", "capture", "keysets"))
    results = capture_all(_source(spark, args), args.database, list(names), state, publish, names)
    _report([(r.table, r.error) for r in results])


def _ingest_events(spark: SparkSession, args: argparse.Namespace) -> None:
    raw = _lake(spark, args).table("raw", args.namespace, args.dataset)
    schema = table_schema(args.schema)
    drain_to_raw(_messages(spark, args, args.topic), raw, schema, args.progress)


def _ingest_table(spark: SparkSession, args: argparse.Namespace) -> None:
    spec = TableSpec(
        namespace=args.namespace,
        dataset=args.dataset,
        table_key=(),
        checkpoint_column=args.checkpoint_column,
        custom_query=args.custom_query,
    )
    lake = _lake(spark, args)
    ingest_table(lake, _source(spark, args), spec, _checkpoints(lake))


def _refine(spark: SparkSession, args: argparse.Namespace) -> None:
    spec = TableSpec(
        namespace=args.namespace,
        dataset=args.dataset,
        table_key=tuple(args.table_key),
        checkpoint_column=args.checkpoint_column,
        ignore_columns=tuple(args.ignore_columns),
        schema=table_schema(args.schema) if args.schema else None,
        topic=args.topic,
        separator=args.hyphen_separator,
        merge=args.merge,
        newer_than=args.newer_than,
        partition_by=tuple(args.partition_by),
        retention_hours=args.retention_hours,
    )
    lake = _lake(spark, args)
    if args.only_new:
        refine_new(lake, spec, _refined(lake))
    else:
        refine(lake, spec)


def _run(spark: SparkSession, args: argparse.Namespace) -> None:
    lake = _lake(spark, args)
    config = _config(args.config)
    sources = _group_sources(spark, args, config)
    runs = run_tables(
        lake,
        specs_from_config(config),
        _checkpoints(lake),
        source=lambda spec: sources.get(spec.namespace) or _source(spark, args),
        messages=lambda spec: _messages(spark, args, spec.topic, spec.servers),
        stream_checkpoints=args.progress,
        load_at=datetime.now(UTC),
        at_once=args.at_once,
        refined=None if args.full else _refined(lake),
        files_per_batch=args.files_per_batch,
    )
    _report([(r.spec.dataset, r.error) for r in runs])


def _count_words(spark: SparkSession, args: argparse.Namespace) -> None:
    count_words(spark.read.text(args.input), "value").write.parquet(args.output)


JOBS = {
    "capture": _capture,
    "ingest-events": _ingest_events,
    "ingest-table": _ingest_table,
    "refine": _refine,
    "run": _run,
    "count-words": _count_words,
}


def _lake(spark: SparkSession, args: argparse.Namespace) -> Lake:
    return Lake(spark, args.root, args.environment, args.format)


def _checkpoints(lake: Lake) -> CheckpointState:
    return CheckpointState(lake.table("state", "ingest", "checkpoints"))


def _refined(lake: Lake) -> RefinedState:
    return RefinedState(lake.table("state", "refine", "batches"))


def _source(spark: SparkSession, args: argparse.Namespace) -> CatalogSource | JdbcSource:
    if not args.url:
        return CatalogSource(spark)
    splits = {}
    for text in args.split:
        table, column, tasks, *how = text.split(":")
        kind = RemainderSplit if how == ["remainder"] else Split
        splits[table] = kind(column, int(tasks))
    return JdbcSource(spark, args.url, args.driver, _pairs(args.option), splits)


def _group_sources(
    spark: SparkSession, args: argparse.Namespace, config: dict[str, Any]
) -> dict[str, JdbcSource]:
    """Databases of the groups that name one; the others use that of the command line."""
    shared = _source(spark, args)
    splits = shared.splits if isinstance(shared, JdbcSource) else {}
    return {
        group["connection"]: JdbcSource(
            spark,
            group["url"],
            group.get("driver", args.driver),
            {**_pairs(args.option), **group.get("options", {})},
            splits,
        )
        for group in config.values()
        if group.get("url")
    }


def _messages(
    spark: SparkSession, args: argparse.Namespace, topic: str, servers: str | None = None
):
    servers = args.servers or servers
    if servers:
        return kafka_messages(spark, servers, topic, args.max_offsets, _pairs(args.topic_option))
    return text_messages(spark, topic)


def _pairs(texts: Sequence[str]) -> dict[str, str]:
    return dict(text.split("=", 1) for text in texts)


def _config(path: str) -> dict[str, Any]:
    with open(path, encoding="utf-8") as file:
        if path.endswith(".json"):
            return json.load(file)
        try:
            import yaml
        except ImportError as error:
            raise SystemExit("a YAML configuration needs PyYAML; JSON works without") from error
        return yaml.safe_load(file)


def _report(results: Sequence[tuple[str, Exception | None]]) -> None:
    failed = [f"{name}: {error}" for name, error in results if error is not None]
    if failed:
        raise SystemExit("failed tables:\n" + "\n".join(failed))
