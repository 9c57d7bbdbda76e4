"""Zone tables: scan, append, replace, refine, expire."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.registry import LOAD_AT, LOADED, new_lake, query, table, wall_clock
from medallion.plans import RefinedState, TableSpec, refine, refine_new
from medallion.sources import Lake
from medallion.sources.partitioned import PartitionedTable


@query("SELECT * FROM events")
def zone_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = new_lake(spark)
    lake.write(table(spark, sf_dir, "events"), "raw", "shop", "events")
    return lake.read("raw", "shop", "events").select("*")


@query("""
    SELECT * FROM events WHERE event_type = 'click'
    UNION ALL SELECT * FROM events WHERE event_type <> 'click'
    UNION ALL SELECT * FROM events WHERE event_type = 'click'""")
def zone_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appending twice keeps both copies."""
    events = table(spark, sf_dir, "events")
    clicks = F.col("event_type") == "click"
    lake = new_lake(spark)
    for part in (events.filter(clicks), events.filter(~clicks), events.filter(clicks)):
        lake.write(part, "raw", "shop", "events", mode="append")
    return lake.read("raw", "shop", "events")


@query("SELECT * FROM events WHERE event_type <> 'error'")
def zone_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced by a selection from itself."""
    lake = new_lake(spark)
    lake.write(table(spark, sf_dir, "events"), "trusted", "shop", "events")
    kept = lake.read("trusted", "shop", "events").filter(F.col("event_type") != "error")
    lake.write(kept, "trusted", "shop", "events", mode="overwrite")
    return lake.read("trusted", "shop", "events")


def _refined_customers(spark: SparkSession, sf_dir: str) -> Lake:
    lake = new_lake(spark)
    lake.write(table(spark, sf_dir, "customer"), "raw", "shop", "customer")
    spec = TableSpec(
        namespace="shop",
        dataset="customer",
        table_key=("c_custkey", "c_nationkey"),
        separator=True,
        ignore_columns=("c_name", "c_acctbal"),
    )
    refine(lake, spec, LOAD_AT)
    return lake


@query(f"""
    SELECT *, md5(concat_ws('-', c_custkey, c_nationkey)) AS key, {LOADED} AS timestamp_kafka
    FROM customer""")
def safe_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The safe zone has all columns."""
    return wall_clock(_refined_customers(spark, sf_dir).read("safe", "shop", "customer"))


@query(f"""
    SELECT * EXCLUDE (c_name, c_acctbal),
           md5(concat_ws('-', c_custkey, c_nationkey)) AS key, {LOADED} AS timestamp_kafka
    FROM customer""")
def trusted_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trusted zone has no restricted columns."""
    return wall_clock(_refined_customers(spark, sf_dir).read("trusted", "shop", "customer"))


def _refined_twice(spark: SparkSession, sf_dir: str) -> Lake:
    """Raw grows between two refinements; the second one merges into both zones."""
    events = table(spark, sf_dir, "events")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    spec = TableSpec(
        namespace="shop",
        dataset="events",
        table_key=("user_id",),
        checkpoint_column="ts",
        ignore_columns=("props",),
        merge=True,
    )
    lake = new_lake(spark)
    for arriving in (events.filter(early), events.filter(~early)):
        lake.write(arriving, "raw", "shop", "events")
        refine(lake, spec, LOAD_AT)
    return lake


MERGED_SQL = f"""
    SELECT * EXCLUDE (rn), md5(CAST(user_id AS varchar)) AS key, {LOADED} AS timestamp_kafka
    FROM (SELECT *, row_number() OVER (
              PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn
          FROM events)
    WHERE rn = 1"""


@query(MERGED_SQL)
def safe_zone_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wall_clock(_refined_twice(spark, sf_dir).read("safe", "shop", "events"))


@query(f"SELECT * EXCLUDE (props) FROM ({MERGED_SQL})")
def trusted_zone_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wall_clock(_refined_twice(spark, sf_dir).read("trusted", "shop", "events"))


@query(f"""
    SELECT * EXCLUDE (rn, l_tax),
           md5(CAST(l_orderkey AS varchar) || CAST(l_linenumber AS varchar)) AS key,
           {LOADED} AS timestamp_kafka
    FROM (SELECT *, row_number() OVER (
              PARTITION BY l_orderkey, l_linenumber
              ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC, l_suppkey DESC,
                       l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC,
                       l_returnflag DESC, l_linestatus DESC) AS rn
          FROM lineitem)
    WHERE rn = 1""")
def trusted_zone_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two key columns without a separator; ties broken by all columns."""
    lake = new_lake(spark)
    lake.write(table(spark, sf_dir, "lineitem"), "raw", "shop", "lineitem")
    spec = TableSpec(
        namespace="shop",
        dataset="lineitem",
        table_key=("l_orderkey", "l_linenumber"),
        checkpoint_column="l_shipdate",
        ignore_columns=("l_tax",),
    )
    refine(lake, spec, LOAD_AT)
    return wall_clock(lake.read("trusted", "shop", "lineitem"))


@query("SELECT *, 1 AS versions FROM events WHERE event_type <> 'error'")
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replaced content is deleted, the current version stays."""
    events = table(spark, sf_dir, "events")
    target = new_lake(spark).table("trusted", "shop", "events")
    target.append(events)
    target.replace(events)
    target.replace(target.read().filter(F.col("event_type") != "error"))
    target.expire(hours=0)
    return target.read().withColumn("versions", F.lit(len(target.versions())))


@query(f"""
    SELECT * EXCLUDE (rn), md5(CAST(l_orderkey AS varchar)) AS key, {LOADED} AS timestamp_kafka
    FROM (SELECT l_orderkey, l_shipdate, l_partkey, l_suppkey, l_comment_free,
                 row_number() OVER (PARTITION BY l_orderkey
                     ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC, l_suppkey DESC,
                              l_comment_free DESC) AS rn
          FROM (SELECT l_orderkey, date_trunc('year', l_shipdate) AS l_shipdate, l_partkey,
                       l_suppkey, l_returnflag AS l_comment_free FROM lineitem))
    WHERE rn = 1""")
def trusted_zone_ties_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one key with equal checkpoints arrive in different batches."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.date_trunc("year", "l_shipdate").cast("timestamp_ntz").alias("l_shipdate"),
        "l_partkey",
        "l_suppkey",
        F.col("l_returnflag").alias("l_comment_free"),
    )
    spec = TableSpec("shop", "lines", ("l_orderkey",), checkpoint_column="l_shipdate", merge=True)
    lake = new_lake(spark)
    state = RefinedState(lake.table("state", "refine", "batches"))
    for number in range(3):
        arriving = lines.filter(F.col("l_partkey") % 3 == (2 - number))
        lake.table("raw", "shop", "lines").add_batch(arriving, "run", number)
        refine_new(lake, spec, state, LOAD_AT)
    return wall_clock(lake.read("trusted", "shop", "lines"))


def _events_spec(hidden: tuple[str, ...]) -> TableSpec:
    return TableSpec(
        "shop", "events", ("user_id",), checkpoint_column="ts", ignore_columns=hidden, merge=True
    )


@query(MERGED_SQL)
def safe_zone_added_later(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column becomes restricted after the first batch: the new safe zone has all rows."""
    events = table(spark, sf_dir, "events")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    lake = new_lake(spark)
    state = RefinedState(lake.table("state", "refine", "batches"))
    for number, (arriving, hidden) in enumerate(
        ((events.filter(early), ()), (events.filter(~early), ("props",)))
    ):
        lake.table("raw", "shop", "events").add_batch(arriving, "run", number)
        refine_new(lake, _events_spec(hidden), state, LOAD_AT)
    return wall_clock(lake.read("safe", "shop", "events"))


@query(f"""
    SELECT * EXCLUDE (rn), md5(CAST(user_id AS varchar)) AS key, {LOADED} AS timestamp_kafka
    FROM (SELECT event_id, ts, user_id, event_type, value,
                 CASE WHEN ts >= '2024-01-16' THEN props END AS props,
                 row_number() OVER (
                     PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn
          FROM events)
    WHERE rn = 1""")
def trusted_zone_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source gets a column after the first batch."""
    events = table(spark, sf_dir, "events")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    lake = new_lake(spark)
    state = RefinedState(lake.table("state", "refine", "batches"))
    for number, arriving in enumerate((events.filter(early).drop("props"), events.filter(~early))):
        lake.table("raw", "shop", "events").add_batch(arriving, "run", number)
        refine_new(lake, _events_spec(()), state, LOAD_AT)
    return wall_clock(lake.read("trusted", "shop", "events"))


@query(f"""
    SELECT * EXCLUDE (rn), md5(concat_ws('-', event_type, user_id)) AS key,
           {LOADED} AS timestamp_kafka
    FROM (SELECT event_id, ts, user_id, event_type, value, row_number() OVER (
              PARTITION BY event_type, user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn
          FROM events)
    WHERE rn = 1""")
def trusted_zone_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merges rewrite only the partitions of the event types that arrive."""
    events = table(spark, sf_dir, "events")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    errors = F.col("event_type") == "error"
    spec = TableSpec(
        "shop",
        "events",
        ("event_type", "user_id"),
        checkpoint_column="ts",
        ignore_columns=("props",),
        separator=True,
        merge=True,
        partition_by=("event_type",),
    )
    lake = new_lake(spark)
    state = RefinedState(lake.table("state", "refine", "batches"))
    for number, arriving in enumerate((~early & ~errors, early & ~errors, errors)):
        lake.table("raw", "shop", "events").add_batch(events.filter(arriving), "run", number)
        refine_new(lake, spec, state, LOAD_AT)
    path = lake.path("trusted", "shop", "events")
    return wall_clock(PartitionedTable(spark, path, spec.partition_by).read())


@query(MERGED_SQL)
def safe_zone_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches arrive newest first; each refinement merges the new one only."""
    events = table(spark, sf_dir, "events")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    spec = TableSpec(
        namespace="shop",
        dataset="events",
        table_key=("user_id",),
        checkpoint_column="ts",
        ignore_columns=("props",),
        merge=True,
    )
    lake = new_lake(spark)
    state = RefinedState(lake.table("state", "refine", "batches"))
    for number, arriving in enumerate((events.filter(~early), events.filter(early))):
        lake.table("raw", "shop", "events").add_batch(arriving, "backfill", number)
        refine_new(lake, spec, state, LOAD_AT)
    return wall_clock(lake.read("safe", "shop", "events"))


@query(f"""
    SELECT * EXCLUDE (props), md5(CAST(event_id AS varchar)) AS key, {LOADED} AS timestamp_kafka
    FROM events""")
def trusted_zone_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table without natural partitions, in buckets of its key: late rows and corrections
    rewrite the buckets of their keys only."""
    events = table(spark, sf_dir, "events")
    late = F.col("event_id") % 997 == 0
    spec = TableSpec(
        "shop",
        "events",
        ("event_id",),
        checkpoint_column="ts",
        ignore_columns=("props",),
        merge=True,
        buckets=16,
    )
    lake = new_lake(spark)
    state = RefinedState(lake.table("state", "refine", "batches"))
    first = events.filter(~late).withColumn("value", F.lit(0.0)).withColumn("ts", F.col("ts") - F.expr("interval 1 year"))
    for number, arriving in enumerate((first, events.filter(late), events.filter(~late))):
        lake.table("raw", "shop", "events").add_batch(arriving, "run", number)
        refine_new(lake, spec, state, LOAD_AT)
    path = lake.path("trusted", "shop", "events")
    return wall_clock(PartitionedTable(spark, path, buckets=spec.buckets).read())
