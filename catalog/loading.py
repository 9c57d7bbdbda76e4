"""Incremental reads, checkpoints, table ingest, configured runs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.events import _messages
from catalog.registry import LOAD_AT, LOADED, new_lake, query, table, wall_clock
from medallion.functions import checkpoint_key
from medallion.operators import largest, lookup, rows_after, rows_since, to_state
from medallion.plans import CheckpointState, TableSpec, ingest_table, run_tables
from medallion.sources import (
    CatalogSource,
    Lake,
    new_scratch,
    staged,
    text_messages,
    write_text,
)

NEW_YEAR = "1998-01-01 00:00:00"


@contextmanager
def _view(spark: SparkSession) -> Iterator[str]:
    name = f"orders_{uuid4().hex}"
    try:
        yield name
    finally:
        spark.catalog.dropTempView(name)


def _checkpoints(lake: Lake) -> CheckpointState:
    return CheckpointState(lake.table("state", "ingest", "checkpoints"))


@query("SELECT * FROM orders WHERE o_orderdate >= timestamp '1998-01-01'")
def incremental_ge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows at or after a checkpoint."""
    return rows_since(table(spark, sf_dir, "orders"), "o_orderdate", NEW_YEAR)


@query("SELECT * FROM orders WHERE o_orderkey > (SELECT floor(avg(o_orderkey)) FROM orders)")
def incremental_keyset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows above the last processed id."""
    orders = table(spark, sf_dir, "orders")
    processed = orders.agg(F.floor(F.avg("o_orderkey"))).first()[0]
    return rows_after(orders, "o_orderkey", processed)


@query("SELECT max(o_orderdate) AS last_value FROM orders WHERE o_orderdate >= '1998-01-01'")
def checkpoint_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checkpoint an increment leads to."""
    increment = rows_since(table(spark, sf_dir, "orders"), "o_orderdate", NEW_YEAR)
    return largest(increment, "o_orderdate")


@query("SELECT max(o_orderkey) AS last_value FROM orders")
def keyset_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The id a first poll leads to."""
    return largest(rows_after(table(spark, sf_dir, "orders"), "o_orderkey"), "o_orderkey")


@query("SELECT max(ts) AS last_timestamp FROM events WHERE event_type = 'purchase'")
def checkpoint_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dataset's checkpoint from the state of all."""
    state = to_state(table(spark, sf_dir, "events"), "events", "event_type", "ts")
    return lookup(state, checkpoint_key("events", "purchase"))


@query("""
    WITH datasets AS (
        SELECT CAST(o_custkey AS varchar) AS table_name,
               max(o_orderdate) FILTER (o_orderdate < '1998-01-01') AS before,
               max(o_orderdate) FILTER (o_orderdate >= '1998-01-01') AS later
        FROM orders GROUP BY o_custkey)
    SELECT 'orders' AS namespace, table_name, 'prd_raw_orders_' || table_name AS key_column,
           'o_orderdate' AS checkpoint_column, coalesce(later, before) AS last_timestamp
    FROM datasets""")
def checkpoint_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One checkpoint per customer: known keys are updated, new ones inserted,
    those without news are kept."""
    orders = table(spark, sf_dir, "orders")
    early = F.col("o_orderdate") < F.lit(NEW_YEAR).cast("timestamp_ntz")
    state = _checkpoints(new_lake(spark))
    for increment in (orders.filter(early), orders.filter(~early)):
        latest = to_state(increment, "orders", "o_custkey", "o_orderdate")
        with staged(spark, latest, "state") as rows:
            state.upsert(rows)
    return state.table.read()


@query("SELECT * FROM orders")
def ingest_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a checkpoint column the whole table is appended."""
    lake = new_lake(spark)
    with _view(spark) as view:
        table(spark, sf_dir, "orders").createOrReplaceTempView(view)
        spec = TableSpec("shop", view, ("o_orderkey",))
        ingest_table(lake, CatalogSource(spark), spec, _checkpoints(lake))
        return lake.read("raw", "shop", view)


def _ingest_twice(spark: SparkSession, sf_dir: str, lake: Lake) -> str:
    """Two runs while the table grows."""
    orders = table(spark, sf_dir, "orders")
    early = F.col("o_orderdate") < F.lit(NEW_YEAR).cast("timestamp_ntz")
    with _view(spark) as view:
        spec = TableSpec("shop", view, ("o_orderkey",), checkpoint_column="o_orderdate")
        for so_far in (orders.filter(early), orders):
            so_far.createOrReplaceTempView(view)
            ingest_table(lake, CatalogSource(spark), spec, _checkpoints(lake))
        return view


@query("""
    SELECT * FROM orders WHERE o_orderdate < '1998-01-01'
    UNION ALL
    SELECT * FROM orders WHERE o_orderdate >= (
        SELECT max(o_orderdate) FROM orders WHERE o_orderdate < '1998-01-01')""")
def ingest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run reads from the first one's checkpoint on, rows equal to it
    once more."""
    lake = new_lake(spark)
    return lake.read("raw", "shop", _ingest_twice(spark, sf_dir, lake))


@query("SELECT * FROM orders")
def ingest_repeated_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that its scheduler starts again, after its checkpoint was saved."""
    lake = new_lake(spark)
    with _view(spark) as view:
        table(spark, sf_dir, "orders").createOrReplaceTempView(view)
        spec = TableSpec("shop", view, ("o_orderkey",), checkpoint_column="o_orderdate")
        for _ in range(2):
            ingest_table(lake, CatalogSource(spark), spec, _checkpoints(lake), run_id="run_1")
        return lake.read("raw", "shop", view)


@query("""
    SELECT 'shop' AS namespace, 'o_orderdate' AS checkpoint_column,
           max(o_orderdate) AS last_timestamp
    FROM orders""")
def ingest_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state two runs leave behind."""
    lake = new_lake(spark)
    _ingest_twice(spark, sf_dir, lake)
    state = _checkpoints(lake).read()
    return state.select("namespace", "checkpoint_column", "last_timestamp")


@query("""
    SELECT o_orderkey, o_custkey, o_totalprice, 0 AS checkpoints
    FROM orders WHERE o_orderstatus = 'F'""")
def custom_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query of the user's own; it saves no checkpoint."""
    lake = new_lake(spark)
    state = _checkpoints(lake)
    with _view(spark) as view:
        table(spark, sf_dir, "orders").createOrReplaceTempView(view)
        spec = TableSpec(
            "shop",
            view,
            ("o_orderkey",),
            checkpoint_column="o_orderdate",
            custom_query=f"SELECT o_orderkey, o_custkey, o_totalprice FROM {view} "
            "WHERE o_orderstatus = 'F'",
        )
        ingest_table(lake, CatalogSource(spark), spec, state)
        saved = state.read().count()
        return lake.read("raw", "shop", view).withColumn("checkpoints", F.lit(saved))


@query(f"""
    SELECT 'events' AS dataset, md5(CAST(user_id AS varchar)) AS key, max(ts) AS newest,
           {LOADED} AS timestamp_kafka
    FROM events GROUP BY user_id
    UNION ALL
    SELECT 'orders', md5(CAST(o_custkey AS varchar)), max(o_orderdate), {LOADED}
    FROM orders GROUP BY o_custkey""")
def config_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table from change events, one from a database, both refined."""
    events, orders = table(spark, sf_dir, "events"), table(spark, sf_dir, "orders")
    lake, topic = new_lake(spark), new_scratch(spark, "topic")
    write_text(_messages(events), topic)
    with _view(spark) as view:
        orders.createOrReplaceTempView(view)
        specs = [
            TableSpec(
                "shop",
                "events",
                ("user_id",),
                checkpoint_column="ts",
                topic="events",
                schema=events.schema,
            ),
            TableSpec("shop", view, ("o_custkey",), checkpoint_column="o_orderdate"),
        ]
        runs = run_tables(
            lake,
            specs,
            _checkpoints(lake),
            source=lambda spec: CatalogSource(spark),
            messages=lambda spec: text_messages(spark, topic),
            stream_checkpoints=new_scratch(spark, "progress"),
            load_at=LOAD_AT,
        )
        for run in runs:
            if run.error:
                raise run.error
        parts = [
            lake.read("trusted", "shop", name).select(
                F.lit(label).alias("dataset"),
                "key",
                F.col(column).alias("newest"),
                "timestamp_kafka",
            )
            for label, name, column in (
                ("events", "events", "ts"),
                ("orders", view, "o_orderdate"),
            )
        ]
    return wall_clock(parts[0].unionByName(parts[1]))
