import random

import pytest
from medallion.operators import count_words, exact_distinct, latest_per_key, one_per_key


@pytest.fixture
def history(spark):
    generator = random.Random(3)
    rows = [
        (
            generator.choice([None, 1, 2, 3, 4]),
            generator.choice([None, "x", "y"]),
            generator.choice([None, 1, 2, 3]),
            generator.choice([None, 0.5, 1.5]),
        )
        for _ in range(400)
    ]
    return rows, spark.createDataFrame(rows, "k int, part string, at int, v double").repartition(7)


def nulls_last(values):
    return tuple((v is not None, v if v is not None else 0) for v in values)


def latest_by_hand(rows):
    best = {}
    for row in rows:
        key = row[:2]
        if key not in best or nulls_last(row[2:]) > nulls_last(best[key][2:]):
            best[key] = row
    return sorted(best.values(), key=repr)


def test_latest_equals_brute_force_with_ties_and_null_keys(history, rows):
    data, df = history
    assert rows(latest_per_key(df, ["k", "part"], "at")) == latest_by_hand(data)


def test_removing_copies_first_changes_nothing(history, rows):
    _, df = history
    once = latest_per_key(df, ["k", "part"], "at")
    assert rows(latest_per_key(exact_distinct(df), ["k", "part"], "at")) == rows(once)


def test_latest_twice_is_latest_once(history, rows):
    _, df = history
    once = latest_per_key(df, ["k"], "at")
    assert rows(latest_per_key(once, ["k"], "at")) == rows(once)


def test_exact_distinct(history, rows):
    data, df = history
    assert rows(exact_distinct(df)) == sorted(set(data), key=repr)


def test_null_checkpoint_loses(spark, rows):
    df = spark.createDataFrame([(1, None, "new"), (1, 0, "old")], "k int, at int, v string")
    assert rows(latest_per_key(df, ["k"], "at")) == [(1, 0, "old")]


def test_one_per_key_keeps_one_existing_row(history):
    data, df = history
    kept = [tuple(r) for r in one_per_key(df, ["k", "part"]).collect()]
    assert len(kept) == len({r[:2] for r in data})
    assert set(kept) <= set(data)


def test_one_per_key_with_an_order_is_determined(history, rows):
    data, df = history
    assert rows(one_per_key(df, ["k", "part"], ["at", "v"])) == latest_by_hand(data)


def test_unorderable_columns_need_a_tie_break(spark, rows):
    df = spark.sql("SELECT 1 AS k, 2 AS at, 5 AS n, map('a', 1) AS m")
    with pytest.raises(ValueError, match="m"):
        latest_per_key(df, ["k"], "at")
    assert latest_per_key(df, ["k"], "at", ["n"]).count() == 1


def test_nested_columns_take_part_in_the_order(spark):
    df = spark.sql(
        "SELECT 1 AS k, 2 AS at, struct(array(a) AS s) AS n FROM VALUES (1), (3), (2) AS t(a)"
    )
    assert latest_per_key(df, ["k"], "at").first().n.s == [3]


def test_latest_reduces_before_its_only_shuffle(history):
    _, df = history
    plan = latest_per_key(df, ["k"], "at")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index(", Final") < plan.index("Exchange hashpartitioning") < plan.index(", Partial")


def test_a_hot_key_sends_one_row_per_partition(spark):
    """A key with every row reaches the reducer as one row per input partition."""
    df = spark.range(0, 200_000, 1, 16).selectExpr("if(id >= 0, 1, id) AS k", "id AS at")
    latest = latest_per_key(df, ["k"], "at")
    assert latest.first() == (1, 199_999)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = latest_per_key(df, ["k"], "at")._jdf.queryExecution().executedPlan()
        plan.execute().count()
        node = plan
        while node.nodeName() != "Exchange":
            node = node.children().head()
        assert node.metrics().apply("shuffleRecordsWritten").value() == 16
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_words_are_split_on_every_single_space(spark, rows):
    texts = ["a b  a", "", " b", "a\tb a\nb", None]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    expected = {}
    for text in texts:
        for word in text.split(" ") if text is not None else []:
            expected[word] = expected.get(word, 0) + 1
    assert rows(count_words(df, "text")) == sorted(expected.items(), key=repr)
