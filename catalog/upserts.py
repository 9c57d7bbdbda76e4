"""Upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.registry import new_lake, query, table
from medallion.operators import profile_source, upsert


def _zeroed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events but the clicks, with value 0."""
    events = table(spark, sf_dir, "events").filter(F.col("event_type") != "click")
    return events.select("event_id", "user_id", F.lit(0.0).alias("value"))


def _changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events but the views, with their value."""
    events = table(spark, sf_dir, "events").filter(F.col("event_type") != "view")
    return events.select("event_id", "user_id", "value")


UPSERT_SQL = """
    WITH lake AS (SELECT event_id, user_id, CAST(0 AS double) AS value FROM events
                  WHERE event_type <> 'click'),
         source AS (SELECT event_id, user_id, value FROM events WHERE event_type <> 'view')
    SELECT lake.* FROM lake
    WHERE NOT EXISTS (SELECT 1 FROM source WHERE lake.event_id = source.event_id)
    UNION ALL SELECT * FROM source"""


@query(UPSERT_SQL)
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views are kept, clicks inserted, the rest updated."""
    lake, source = _zeroed(spark, sf_dir), _changed(spark, sf_dir)
    return upsert(lake, source, ["event_id"], profile=profile_source(source, ["event_id"]))


@query(UPSERT_SQL)
def upsert_merge_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same when the source keys are too many to broadcast."""
    lake, source = _zeroed(spark, sf_dir), _changed(spark, sf_dir)
    profile = profile_source(source, ["event_id"])
    return upsert(lake, source, ["event_id"], profile=profile, broadcast_limit=0)


@query("""
    WITH lake AS (SELECT CASE WHEN event_type <> 'error' THEN 'e' || event_id END AS nk,
                         event_id, 0 AS side FROM events WHERE event_type <> 'click'),
         source AS (SELECT CASE WHEN event_type <> 'error' THEN 'e' || event_id END AS nk,
                           event_id, 1 AS side FROM events WHERE event_type <> 'view')
    SELECT lake.* FROM lake WHERE NOT EXISTS (SELECT 1 FROM source WHERE lake.nk = source.nk)
    UNION ALL SELECT * FROM source""")
def upsert_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events have no key on either side: none match, all stay."""
    events = table(spark, sf_dir, "events")
    key = F.when(F.col("event_type") != "error", F.concat(F.lit("e"), "event_id")).alias("nk")
    lake = events.filter(F.col("event_type") != "click").select(
        key, "event_id", F.lit(0).alias("side")
    )
    source = events.filter(F.col("event_type") != "view").select(
        key, "event_id", F.lit(1).alias("side")
    )
    profile = profile_source(source, ["nk"])
    return upsert(lake, source, ["nk"], profile=profile, broadcast_limit=0)


@query("""
    WITH early AS (
             SELECT o_custkey, max(o_orderdate) AS d, 'open' AS status
             FROM orders WHERE o_orderstatus <> 'F' GROUP BY o_custkey),
         final AS (
             SELECT o_custkey, max(o_orderdate) AS d, 'final' AS status
             FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey)
    SELECT coalesce(final.o_custkey, early.o_custkey) AS o_custkey,
           CASE WHEN final.d IS NULL OR early.d > final.d THEN early.d ELSE final.d END AS d,
           CASE WHEN final.d IS NULL OR early.d > final.d THEN 'open' ELSE 'final' END AS status
    FROM early FULL JOIN final ON early.o_custkey = final.o_custkey""")
def upsert_newer_than(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only source rows that are at least as new replace a row."""
    orders = table(spark, sf_dir, "orders")

    final = F.col("o_orderstatus") == "F"

    def last_of(chosen: Column, status: str) -> DataFrame:
        latest = orders.filter(chosen).groupBy("o_custkey").agg(F.max("o_orderdate").alias("d"))
        return latest.withColumn("status", F.lit(status))

    source = last_of(final, "final")
    profile = profile_source(source, ["o_custkey"])
    return upsert(last_of(~final, "open"), source, ["o_custkey"], newer_than="d", profile=profile)


@query("""
    WITH early AS (
             SELECT o_custkey, max(o_orderdate) AS d, 'open' AS status
             FROM orders WHERE o_orderstatus <> 'F' GROUP BY o_custkey),
         final AS (
             SELECT o_custkey, max(o_orderdate) AS d, 'final' AS status
             FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey)
    SELECT coalesce(final.o_custkey, early.o_custkey) AS o_custkey,
           CASE WHEN final.d IS NULL OR early.d > final.d THEN early.d ELSE final.d END AS d,
           CASE WHEN final.d IS NULL OR early.d > final.d THEN 'open' ELSE 'final' END AS status
    FROM early FULL JOIN final ON early.o_custkey = final.o_custkey""")
def upsert_newer_than_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in one shuffled join, for a target that holds each key once."""
    orders = table(spark, sf_dir, "orders")
    final = F.col("o_orderstatus") == "F"

    def last_of(chosen: Column, status: str) -> DataFrame:
        latest = orders.filter(chosen).groupBy("o_custkey").agg(F.max("o_orderdate").alias("d"))
        return latest.withColumn("status", F.lit(status))

    return upsert(
        last_of(~final, "open"),
        last_of(final, "final"),
        ["o_custkey"],
        newer_than="d",
        broadcast_limit=0,
        unique=True,
    )


@query(UPSERT_SQL)
def first_load_or_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first call finds no table and loads it, the second merges."""
    target = new_lake(spark).table("trusted", "shop", "events")
    target.merge(_zeroed(spark, sf_dir), ["event_id"])
    target.merge(_changed(spark, sf_dir), ["event_id"])
    return target.read()
