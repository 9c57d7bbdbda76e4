"""Keys, load timestamp, date guard, duplicates, restricted columns, words."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.registry import LOAD_AT, LOADED, query, table, wall_clock
from medallion.functions import guard_dates, surrogate_key, with_load_timestamp
from medallion.operators import (
    count_words,
    drop_restricted,
    exact_distinct,
    latest_per_key,
    one_per_key,
)
from medallion.plans import refine_frame


@query(f"""
    SELECT event_id, ts, user_id, event_type, value, props,
           md5(CAST(user_id AS varchar)) AS key, {LOADED} AS timestamp_kafka
    FROM (SELECT *, row_number() OVER (
              PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn
          FROM events)
    WHERE rn = 1""")
def raw_to_trusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current state per user."""
    events = table(spark, sf_dir, "events")
    return wall_clock(refine_frame(events, ["user_id"], "ts", separator=True, load_at=LOAD_AT))


@query(f"""
    SELECT * EXCLUDE (rn), md5(concat_ws('-', l_orderkey, l_linenumber)) AS key,
           {LOADED} AS timestamp_kafka
    FROM (SELECT *, row_number() OVER (
              PARTITION BY l_orderkey, l_linenumber
              ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC, l_suppkey DESC,
                       l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC,
                       l_returnflag DESC, l_linestatus DESC) AS rn
          FROM (SELECT DISTINCT * FROM lineitem))
    WHERE rn = 1""")
def raw_to_trusted_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current state per order line."""
    lines = table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    return wall_clock(refine_frame(lines, keys, "l_shipdate", separator=True, load_at=LOAD_AT))


@query("""
    SELECT l_orderkey, l_linenumber, md5(concat_ws('-', l_orderkey, l_linenumber)) AS key
    FROM lineitem""")
def key_hyphen(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    return table(spark, sf_dir, "lineitem").select(
        *keys, surrogate_key(keys, separator=True).alias("key")
    )


@query("""
    SELECT l_orderkey, l_linenumber,
           md5(CAST(l_orderkey AS varchar) || CAST(l_linenumber AS varchar)) AS key
    FROM lineitem""")
def key_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    return table(spark, sf_dir, "lineitem").select(*keys, surrogate_key(keys).alias("key"))


def _events_with_null_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.nullif(F.col("event_type"), F.lit("error"))
    return table(spark, sf_dir, "events").withColumn("kind", kind)


@query("""
    SELECT event_id, md5(concat_ws('-', user_id, nullif(event_type, 'error'))) AS key
    FROM events""")
def key_hyphen_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null parts are skipped."""
    key = surrogate_key(["user_id", "kind"], separator=True)
    return _events_with_null_types(spark, sf_dir).select("event_id", key.alias("key"))


@query("""
    SELECT event_id, md5(CAST(user_id AS varchar) || nullif(event_type, 'error')) AS key
    FROM events""")
def key_concat_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null part makes the key null."""
    key = surrogate_key(["user_id", "kind"])
    return _events_with_null_types(spark, sf_dir).select("event_id", key.alias("key"))


@query(f"SELECT o_orderkey, {LOADED} AS timestamp_kafka FROM orders")
def load_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wall_clock(
        with_load_timestamp(table(spark, sf_dir, "orders").select("o_orderkey"), LOAD_AT)
    )


@query("""
    SELECT o_orderkey, CAST(CASE WHEN year(d) >= 10 THEN d END AS varchar) AS d
    FROM (SELECT o_orderkey, o_orderdate - INTERVAL 1990 YEAR AS d FROM orders)""")
def date_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates moved to the years 5 to 11; those before year 10 become null.
    As text, which every reader of the result can represent."""
    shift = F.expr("INTERVAL '1990' YEAR")
    early = table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_orderdate") - shift).alias("d")
    )
    return guard_dates(early).withColumn("d", F.col("d").cast("string"))


@query("""
    SELECT DISTINCT * FROM (
        SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_type = 'click')""")
def dedup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return exact_distinct(events.unionByName(events.filter(F.col("event_type") == "click")))


@query("""
    SELECT event_id, ts, user_id FROM (
        SELECT *, row_number() OVER (
            PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn
        FROM events)
    WHERE rn = 1""")
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    return latest_per_key(events, ["user_id"], "ts")


@query("""
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC, l_suppkey DESC,
                     l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC,
                     l_returnflag DESC, l_linestatus DESC) AS rn
        FROM (SELECT DISTINCT * FROM lineitem))
    WHERE rn = 1""")
def dedup_latest_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ties on the ship date are broken by all other columns."""
    keys = ["l_orderkey", "l_linenumber"]
    return latest_per_key(table(spark, sf_dir, "lineitem"), keys, "l_shipdate")


@query("SELECT DISTINCT md5(concat_ws('-', l_orderkey, l_linenumber)) AS key FROM lineitem")
def dedup_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any row per key; only the keys are comparable."""
    key = surrogate_key(["l_orderkey", "l_linenumber"], separator=True)
    lines = table(spark, sf_dir, "lineitem").withColumn("key", key)
    return one_per_key(lines, ["key"]).select("key")


@query("SELECT c_custkey, c_nationkey, c_mktsegment FROM customer", name="drop_restricted")
def without_restricted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The third name does not exist and is ignored."""
    return drop_restricted(table(spark, sf_dir, "customer"), ["c_name", "c_acctbal", "c_phone"])


@query("""
    SELECT word, count(*) AS n
    FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
    GROUP BY word""")
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_words(table(spark, sf_dir, "documents"), "text")
