import os
import time
from datetime import date, datetime, timedelta, timezone
from hashlib import md5

import pytest
from medallion.functions import (
    checkpoint_key,
    guard_dates,
    load_instant,
    surrogate_key,
    with_load_timestamp,
)


def digest(text):
    return md5(text.encode()).hexdigest()


@pytest.fixture
def parts(spark):
    rows = [
        ("a", None, "b"),
        ("a", "b", None),
        ("1", "23", ""),
        ("12", "3", ""),
        (None, None, None),
    ]
    return spark.createDataFrame(rows, "x string, y string, z string")


def keys_of(df, **options):
    key = surrogate_key(["x", "y", "z"], **options).alias("key")
    return [r.key for r in df.select(key).collect()]


def test_separated_key_skips_nulls_and_so_collides(parts):
    expected = ["a-b", "a-b", "1-23-", "12-3-", ""]
    assert keys_of(parts, separator=True) == [digest(t) for t in expected]


def test_glued_key_is_null_on_any_null_and_collides_across_parts(parts):
    assert keys_of(parts) == [None, None, digest("123"), digest("123"), None]


def test_null_token_tells_null_positions_apart(parts):
    keys = keys_of(parts, separator=True, null_token="~")
    assert keys[:2] == [digest("a-~-b"), digest("a-b-~")]
    assert len(set(keys)) == 5


def test_key_of_numbers_is_the_hash_of_their_text(spark):
    df = spark.createDataFrame([(7, 42)], "a bigint, b int")
    row = df.select(
        surrogate_key(["a", "b"]).alias("glued"), surrogate_key(["a", "b"], True).alias("joined")
    ).first()
    assert row == (digest("742"), digest("7-42"))


def test_key_needs_a_column():
    with pytest.raises(ValueError):
        surrogate_key([])


def test_checkpoint_key():
    assert checkpoint_key("shop", "orders") == "prd_raw_shop_orders"


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
def test_guard_nulls_years_before_ten_and_keeps_the_type(spark, kind):
    text = ["0001-06-15", "0009-12-31", "0010-01-01", "0011-02-03", "2024-02-29", None]
    df = spark.createDataFrame([(t,) for t in text], "t string")
    df = df.selectExpr("t", f"CAST(t AS {kind}) AS d")
    guarded = guard_dates(df)
    assert guarded.schema == df.schema
    kept = [r.d for r in guarded.selectExpr("CAST(CAST(d AS date) AS string) AS d").collect()]
    assert kept == [None, None, *text[2:]]


def test_guard_leaves_other_columns(spark):
    df = spark.createDataFrame([(5, "0001-01-01")], "year int, text string")
    assert guard_dates(df).collect() == df.collect()


def test_load_timestamp_is_one_value_cut_to_the_second(spark):
    at = datetime(2024, 2, 1, 10, 11, 12, 999999)
    df = with_load_timestamp(spark.range(1000).repartition(8), at)
    assert [tuple(r) for r in df.select("timestamp_kafka").distinct().collect()] == [
        (datetime(2024, 2, 1, 10, 11, 12),)
    ]
    assert df.schema["timestamp_kafka"].dataType.simpleString() == "timestamp"
    assert spark.range(1).select(load_instant()).first()[0].microsecond == 0


def test_load_timestamp_is_an_instant_in_any_zone(spark):
    at = datetime(2024, 2, 1, 10, 11, 12, tzinfo=timezone(timedelta(hours=-5)))
    before, machine = spark.conf.get("spark.sql.session.timeZone"), os.environ.get("TZ")
    try:
        os.environ["TZ"] = "America/New_York"
        time.tzset()
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        for given, seconds in ((at, 1_706_800_272), (None, int(time.time()))):
            stamp = with_load_timestamp(spark.range(1), given)
            found = stamp.selectExpr("unix_seconds(timestamp_kafka)").first()[0]
            assert 0 <= found - seconds <= 5
    finally:
        os.environ.pop("TZ")
        if machine:
            os.environ["TZ"] = machine
        time.tzset()
        spark.conf.set("spark.sql.session.timeZone", before)


def test_guard_on_mixed_columns(spark):
    df = spark.createDataFrame([(date(5, 1, 1), datetime(2020, 1, 1))], "d date, t timestamp_ntz")
    assert guard_dates(df).first() == (None, datetime(2020, 1, 1))
