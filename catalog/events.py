"""Change events: build, parse, reject, capture, stream."""

from __future__ import annotations

from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.registry import TS_MS, new_lake, query, table
from medallion.operators import accepted, build_envelope, flatten, parse_envelope, rejected
from medallion.operators.envelope import event_schema
from medallion.plans import KeysetState, capture_all, capture_table, read_quarantine, read_raw
from medallion.sources import CatalogSource, Lake, new_scratch, text_messages, write_text
from medallion.streaming import drain_to_raw, parse_again


def _messages(events: DataFrame) -> DataFrame:
    return events.select(build_envelope(events, "lake", "events", TS_MS).alias("value"))


def _damaged(events: DataFrame) -> DataFrame:
    """Messages of error events lose their end."""
    whole = build_envelope(events, "lake", "events", TS_MS)
    cut = F.substring(whole, F.lit(1), F.length(whole) - 2)
    return events.select(
        F.when(F.col("event_type") == "error", cut).otherwise(whole).alias("value")
    )


def _ids(texts: DataFrame) -> DataFrame:
    return texts.select(
        F.regexp_extract("rejected", r'"event_id":(\d+)', 1).cast("bigint").alias("event_id")
    )


@query(f"""
    SELECT CAST(json_object(
        'operation', 'insert',
        'before', json('{{}}'),
        'after', json_object(
            'event_id', event_id,
            'ts', regexp_replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '\\.000000$', ''),
            'user_id', user_id, 'event_type', event_type, 'value', value, 'props', props),
        'source', json_object('db', 'lake', 'table', 'events'),
        'ts_ms', {TS_MS}) AS varchar) AS value
    FROM events""")
def envelope_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _messages(table(spark, sf_dir, "events"))


@query(f"""
    SELECT 'insert' AS operation, '{{}}' AS before, 'lake' AS db, 'events' AS tab,
           '{TS_MS}' AS ts_ms, event_id, ts, user_id, event_type, value, props
    FROM events""")
def envelope_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    parsed = accepted(parse_envelope(_messages(events), events.schema))
    return parsed.select(
        "operation",
        "before",
        F.col("source.db").alias("db"),
        F.col("source.table").alias("tab"),
        "ts_ms",
        "after.*",
    )


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def envelope_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return flatten(accepted(parse_envelope(_messages(events), events.schema)))


@query("""
    SELECT o_orderkey, CAST(o_orderdate AS date) AS day,
           CAST(o_totalprice AS decimal(12, 2))::varchar AS price,
           date_trunc('second', o_orderdate) AS moment
    FROM orders""")
def envelope_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates, decimals and timestamps through the text form and back."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
        F.date_trunc("second", "o_orderdate").cast("timestamp_ntz").alias("moment"),
    )
    text = orders.select(build_envelope(orders, "shop", "orders", TS_MS).alias("value"))
    rows = flatten(accepted(parse_envelope(text, orders.schema)))
    return rows.withColumn("price", F.col("price").cast("string"))


@query("SELECT event_id FROM events WHERE event_type = 'error'")
def envelope_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return _ids(rejected(parse_envelope(_damaged(events), events.schema)))


@query("SELECT event_id, CAST(props->>'k' AS bigint) AS k FROM events")
def props_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.from_json("props", "k bigint")["k"].alias("k")
    )


@query("SELECT * FROM orders")
def cdc_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two polls while the table grows: each id is published once."""
    orders = table(spark, sf_dir, "orders")
    topic = new_scratch(spark, "topic")
    state = KeysetState(new_lake(spark).table("state", "capture", "keysets"))
    view = f"orders_{uuid4().hex}"
    middle = orders.agg(F.avg("o_orderkey")).first()[0]
    for so_far in (orders.filter(F.col("o_orderkey") <= middle), orders):
        so_far.createOrReplaceTempView(view)
        capture_table(
            CatalogSource(spark),
            "shop",
            view,
            state,
            lambda messages: write_text(messages, topic),
            id_column="o_orderkey",
            ts_ms=TS_MS,
        )
    spark.catalog.dropTempView(view)
    return flatten(accepted(parse_envelope(spark.read.text(topic), orders.schema)))


IDS = {"customer": "c_custkey", "part": "p_partkey", "supplier": "s_suppkey"}


def _capture_twice(spark: SparkSession, sf_dir: str) -> tuple[KeysetState, dict[str, str]]:
    """Poll three tables to a topic each, two times; the second finds nothing."""
    state = KeysetState(new_lake(spark).table("state", "capture", "keysets"))
    run = uuid4().hex
    topics = {name: new_scratch(spark, "topic") for name in IDS}
    views = {f"{name}_{run}": name for name in IDS}
    for view, name in views.items():
        table(spark, sf_dir, name).createOrReplaceTempView(view)
    for _ in range(2):
        results = capture_all(
            CatalogSource(spark),
            "shop",
            list(views),
            state,
            lambda view, messages: write_text(messages, topics[views[view]]),
            {view: IDS[name] for view, name in views.items()},
        )
        for result in results:
            if result.error:
                raise result.error
    for view in views:
        spark.catalog.dropTempView(view)
    return state, topics


@query("""
    SELECT 'customer' AS tab, c_custkey AS id FROM customer
    UNION ALL SELECT 'part', p_partkey FROM part
    UNION ALL SELECT 'supplier', s_suppkey FROM supplier""")
def cdc_capture_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the topics hold."""
    _, topics = _capture_twice(spark, sf_dir)
    captured = []
    for name, topic in topics.items():
        schema = table(spark, sf_dir, name).schema
        events = accepted(parse_envelope(spark.read.text(topic), schema))
        tab = F.split_part("source.table", F.lit("_"), F.lit(1))
        captured.append(events.select(tab.alias("tab"), F.col(f"after.{IDS[name]}").alias("id")))
    return reduce(DataFrame.unionByName, captured)


@query("""
    SELECT 'customer' AS tab, max(c_custkey) AS last_processed_id FROM customer
    UNION ALL SELECT 'part', max(p_partkey) FROM part
    UNION ALL SELECT 'supplier', max(s_suppkey) FROM supplier""")
def cdc_capture_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the next poll starts."""
    state, _ = _capture_twice(spark, sf_dir)
    tab = F.split_part("key_column", F.lit("_"), F.lit(1))
    return state.read().select(tab.alias("tab"), "last_processed_id")


def _stream(spark: SparkSession, lake: Lake, topic: str, progress: str, events: DataFrame) -> None:
    raw = lake.table("raw", "shop", "events")
    drain_to_raw(text_messages(spark, topic), raw, events.schema, progress)


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def cdc_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to raw by a stream, then the after-images."""
    events = table(spark, sf_dir, "events")
    lake, topic = new_lake(spark), new_scratch(spark, "topic")
    write_text(_messages(events), topic)
    _stream(spark, lake, topic, new_scratch(spark, "progress"), events)
    return read_raw(lake, "shop", "events", from_events=True)


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def cdc_stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs on one checkpoint: first messages, later ones, none."""
    events = table(spark, sf_dir, "events")
    lake, topic, progress = (
        new_lake(spark),
        new_scratch(spark, "topic"),
        new_scratch(spark, "progress"),
    )
    half = F.lit("2024-01-16").cast("timestamp_ntz")
    for arriving in (events.filter(F.col("ts") < half), events.filter(F.col("ts") >= half), None):
        if arriving is not None:
            write_text(_messages(arriving), topic)
        _stream(spark, lake, topic, progress, events)
    return read_raw(lake, "shop", "events", from_events=True)


@query("""
    SELECT event_id, event_type = 'error' AS rejected FROM events""")
def cdc_stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad messages do not stop the stream and are kept as text."""
    events = table(spark, sf_dir, "events")
    lake, topic = new_lake(spark), new_scratch(spark, "topic")
    write_text(_damaged(events), topic)
    _stream(spark, lake, topic, new_scratch(spark, "progress"), events)
    good = read_raw(lake, "shop", "events", from_events=True).select("event_id")
    bad = _ids(read_quarantine(lake, "shop", "events"))
    return good.withColumn("rejected", F.lit(False)).unionByName(
        bad.withColumn("rejected", F.lit(True))
    )


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def raw_read_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw table of change events is flattened."""
    events = table(spark, sf_dir, "events")
    lake = new_lake(spark)
    lake.write(parse_envelope(_messages(events), events.schema), "raw", "shop", "events")
    return read_raw(lake, "shop", "events", from_events=True)


@query("SELECT * FROM events")
def raw_read_jdbc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw table of database rows is read as is."""
    lake = new_lake(spark)
    lake.write(table(spark, sf_dir, "events"), "raw", "shop", "events")
    return read_raw(lake, "shop", "events", from_events=False)


@query("""
    SELECT l_orderkey, l_linenumber::bigint AS l_linenumber, l_quantity::double AS l_quantity,
           l_tax::decimal(4, 2)::double AS l_tax,
           CASE WHEN l_orderkey % 3 = 0 THEN l_shipdate::date::timestamp
                ELSE l_shipdate END AS l_shipdate,
           CASE WHEN l_orderkey % 3 = 2 THEN l_returnflag END AS l_returnflag
    FROM lineitem""")
def raw_read_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source widened four columns and added one, a batch after the other."""
    lines = table(spark, sf_dir, "lineitem")
    kinds = (
        ("int", "float", "decimal(4,2)", "date"),
        ("bigint", "double", "decimal(12,4)", "timestamp_ntz"),
        ("bigint", "double", "decimal(12,4)", "timestamp_ntz"),
    )
    lake = new_lake(spark)
    for number, (whole, real, exact, day) in enumerate(kinds):
        columns = [
            F.col("l_orderkey"),
            F.col("l_linenumber").cast(whole),
            F.col("l_quantity").cast(real),
            F.col("l_tax").cast(exact),
            F.col("l_shipdate").cast(day),
            *(["l_returnflag"] if number == 2 else []),
        ]
        batch = lines.filter(F.col("l_orderkey") % 3 == number).select(*columns)
        lake.table("raw", "shop", "lineitem").add_batch(batch, "run", number)
    read = read_raw(lake, "shop", "lineitem", from_events=False)
    return read.withColumn("l_tax", F.col("l_tax").cast("double"))


@query("""
    SELECT event_id, 1::bigint AS published FROM events""")
def cdc_capture_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids are committed out of order: those that three divides come a poll after larger ones.
    Each is published once."""
    events = table(spark, sf_dir, "events")
    step = (events.agg(F.max("event_id")).first()[0] or 0) // 4 + 1
    state = KeysetState(new_lake(spark).table("state", "capture", "late"), overlap=2 * step)
    topic, view = new_scratch(spark, "topic"), f"late_{uuid4().hex}"
    poll = F.floor(F.col("event_id") / step) + (F.col("event_id") % 3 == 0).cast("int")
    for number in range(5):
        events.filter(poll <= number).createOrReplaceTempView(view)
        capture_table(CatalogSource(spark), "db", view, state, lambda m: write_text(m, topic), "event_id")
    spark.catalog.dropTempView(view)
    found = flatten(accepted(parse_envelope(spark.read.text(topic), events.schema)))
    return found.groupBy("event_id").agg(F.count(F.lit(1)).alias("published"))


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def quarantine_parsed_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wrong schema rejects messages; the right one takes them in, once, also if asked twice."""
    events = table(spark, sf_dir, "events")
    lake, topic = new_lake(spark), new_scratch(spark, "topic")
    write_text(_messages(events), topic)
    wrong = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props bigint"
    raw = lake.table("raw", "shop", "events")
    drain_to_raw(text_messages(spark, topic), raw, wrong, new_scratch(spark, "progress"))
    for _ in range(2):
        parse_again(raw, events.schema)
    return flatten(accepted(raw.read_batches(["run-again/batch-0"], event_schema(events.schema))))
