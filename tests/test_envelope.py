import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from medallion.operators import (
    accepted,
    build_envelope,
    envelope_schema,
    flatten,
    parse_envelope,
    rejected,
)
from medallion.operators.envelope import table_schema
from pyspark.sql import types as T

SCHEMA = "id int, name string, price decimal(10,2), day date, at timestamp_ntz, seen timestamp"
ROWS = [
    (
        1,
        'quote " and é',
        Decimal("12.50"),
        date(2024, 1, 2),
        datetime(2024, 1, 2, 3, 4, 5),
        datetime(2024, 1, 2, 3, 4, 5, 120000),
    ),
    (2, None, None, None, None, None),
    (3, "", Decimal("-0.01"), date(1999, 12, 31), datetime(1, 1, 1), datetime(2050, 6, 1)),
]


@pytest.fixture
def table(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def messages(df):
    return df.select(build_envelope(df, "shop", "items", 123).alias("value"))


def parsed(spark, texts, schema="id int, name string, at timestamp_ntz"):
    return parse_envelope(spark.createDataFrame([(t,) for t in texts], "value string"), schema)


def test_text_is_the_event_with_iso_instants_and_exact_decimals(table):
    events = [json.loads(r.value) for r in messages(table).collect()]
    assert events[0] == {
        "operation": "insert",
        "before": {},
        "after": {
            "id": 1,
            "name": 'quote " and é',
            "price": "12.50",
            "day": "2024-01-02",
            "at": datetime(2024, 1, 2, 3, 4, 5).isoformat(),
            "seen": datetime(2024, 1, 2, 3, 4, 5, 120000).isoformat(),
        },
        "source": {"db": "shop", "table": "items"},
        "ts_ms": 123,
    }
    assert list(events[0]) == ["operation", "before", "after", "source", "ts_ms"]
    assert events[1]["after"] == {
        "id": 2, "name": None, "price": None, "day": None, "at": None, "seen": None
    }


def test_build_parse_flatten_gives_the_table_back(table, rows):
    events = parse_envelope(messages(table), table.schema)
    assert rejected(events).count() == 0
    back = flatten(accepted(events))
    assert back.dtypes == table.dtypes
    assert rows(back) == rows(table)


def test_other_envelope_fields_are_kept_as_text(table):
    row = accepted(parse_envelope(messages(table), SCHEMA)).first()
    assert (row.operation, row.before, row.ts_ms) == ("insert", "{}", "123")
    assert (row.source.db, row.source.table) == ("shop", "items")


def test_fields_are_matched_by_name(spark):
    texts = ['{"zzz": 1, "after": {"at": null, "extra": true, "id": 5}}', '{"after": {}}']
    events = parsed(spark, texts)
    assert [tuple(r) for r in flatten(accepted(events)).collect()] == [
        (5, None, None),
        (None, None, None),
    ]


@pytest.mark.parametrize(
    "text",
    [
        "not json",
        "null",
        "[]",
        "5",
        "",
        "{}",
        '{"after": null}',
        '{"after": 5}',
        '{"after": {"id": 1}',
        '{"after": {"id": "1"}}',
        '{"after": {"id": 1.5}}',
        '{"after": {"id": 99999999999}}',
        '{"after": {"id": 1, "at": "yesterday"}}',
        '[{"after": {"id": 1}}]',
        '{"after": {"id": 1}} more',
        '{"after": {"id": 1}}{"after": {"id": 2}}',
        '{"after": {"id": 1}}, {"after": {"id": 2}}',
    ],
)
def test_a_bad_message_is_kept_as_text_and_does_not_stop_the_good_one(spark, text):
    events = parsed(spark, [text, '{"after": {"id": 1}}'])
    assert [r.rejected for r in rejected(events).collect()] == [text]
    assert [r.id for r in flatten(accepted(events)).collect()] == [1]


def test_a_message_without_value_is_rejected(spark):
    assert [r.rejected for r in rejected(parsed(spark, [None])).collect()] == [""]


def test_null_in_a_field_declared_non_null_is_rejected(spark):
    schema = T.StructType(
        [T.StructField("id", T.LongType(), False), T.StructField("name", T.StringType())]
    )
    events = parsed(spark, ['{"after": {"name": "a"}}', '{"after": {"id": 1}}'], schema)
    assert rejected(events).count() == 1
    assert [r.id for r in flatten(accepted(events)).collect()] == [1]


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ('"2024-01-02T03:04:05"', datetime(2024, 1, 2, 3, 4, 5)),
        ('"2024-01-02T03:04:05.25"', datetime(2024, 1, 2, 3, 4, 5, 250000)),
        ("null", None),
    ],
)
def test_instants(spark, text, value):
    events = parsed(spark, [f'{{"after": {{"id": 1, "at": {text}}}}}'])
    assert flatten(accepted(events)).first()["at"] == value


@pytest.mark.parametrize("text", ['"7.25"', "7.25"])
def test_decimals_come_as_text_or_number(spark, text):
    events = parsed(spark, [f'{{"after": {{"p": {text}}}}}'], "p decimal(10,2)")
    assert flatten(accepted(events)).first().p == Decimal("7.25")


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_a_wall_clock_that_a_zone_skips_survives(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        table = spark.createDataFrame([(datetime(2018, 11, 4, 0, 30),)], "at timestamp_ntz")
        value = messages(table).first().value
        assert json.loads(value)["after"]["at"] == "2018-11-04T00:30:00"
        back = flatten(accepted(parse_envelope(messages(table), table.schema)))
        assert back.first()["at"] == datetime(2018, 11, 4, 0, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_schema_forms():
    as_ddl = table_schema("id int, name string")
    assert table_schema(as_ddl) == as_ddl
    assert table_schema(as_ddl.json()) == as_ddl
    fields = envelope_schema("id int")
    assert [f.name for f in fields] == ["operation", "before", "after", "source", "ts_ms"]
    assert all(f.nullable for f in fields)
