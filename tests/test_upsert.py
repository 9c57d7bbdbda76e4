import random

import pytest
from medallion.operators import SourceProfile, profile_source, upsert

COLUMNS = "a int, b string, at int, v string"
LIMITS = pytest.mark.parametrize("limit", [0, 1 << 30], ids=["shuffled", "broadcast"])


def random_rows(seed, count, label, unique):
    generator = random.Random(seed)
    rows, seen = [], set()
    for n in range(count):
        key = (generator.choice([None, *range(8)]), generator.choice([None, "x", "y", "z"]))
        if unique and None not in key and key in seen:
            continue
        seen.add(key)
        rows.append((*key, generator.choice([None, 1, 2, 3]), f"{label}{n}"))
    return rows


def older(mine, theirs):
    return theirs is None and mine is not None or None not in (mine, theirs) and mine > theirs


def upsert_by_hand(lake, source, guarded):
    def beaten(row, other):
        return None not in row[:2] and row[:2] == other[:2] and not (
            guarded and older(row[2], other[2])
        )

    def stale(row, other):
        return (
            guarded and None not in row[:2] and row[:2] == other[:2] and older(other[2], row[2])
        )

    kept = [row for row in lake if not any(beaten(row, other) for other in source)]
    fresh = [row for row in source if not any(stale(row, other) for other in lake)]
    return sorted(kept + fresh, key=repr)


@LIMITS
@pytest.mark.parametrize("guard", [None, "at"])
@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, rows, limit, guard, seed):
    before = random_rows(seed, 60, "old", unique=False)
    after = random_rows(seed + 100, 40, "new", unique=True)
    lake = spark.createDataFrame(before, COLUMNS).repartition(5)
    source = spark.createDataFrame(after, COLUMNS).repartition(3)
    profile = profile_source(source, ["a", "b"])
    result = upsert(lake, source, ["a", "b"], guard, profile, limit)
    assert rows(result) == upsert_by_hand(before, after, guard is not None)


@LIMITS
@pytest.mark.parametrize("seed", range(3))
def test_a_unique_target_takes_one_join(spark, rows, limit, seed):
    before = random_rows(seed, 60, "old", unique=True)
    after = random_rows(seed + 100, 40, "new", unique=True)
    lake = spark.createDataFrame(before, COLUMNS).repartition(5)
    source = spark.createDataFrame(after, COLUMNS).repartition(3)
    result = upsert(lake, source, ["a", "b"], "at", None, limit, unique=True)
    if not limit:
        assert plan(result).count("SortMergeJoin") == 1
    assert rows(result) == upsert_by_hand(before, after, True)


@LIMITS
def test_several_columns_compare_one_after_the_other(spark, rows, limit):
    columns = "k int, at int, name string"
    lake = spark.createDataFrame([(1, 5, "b"), (2, 5, None), (3, None, "z"), (4, 5, "a")], columns)
    source = spark.createDataFrame([(1, 5, "a"), (2, 5, "a"), (3, 1, None), (4, 5, "a")], columns)
    for unique in (False, True):
        result = upsert(lake, source, ["k"], None, None, limit, ["at", "name"], unique)
        assert rows(result) == [(1, 5, "b"), (2, 5, "a"), (3, 1, None), (4, 5, "a")]


@LIMITS
def test_twice_is_once(spark, rows, limit):
    lake = spark.createDataFrame([(1, "x"), (2, "x")], "k int, v string")
    source = spark.createDataFrame([(2, "y"), (3, "y")], "k int, v string")
    profile = profile_source(source, ["k"])
    once = upsert(lake, source, ["k"], profile=profile, broadcast_limit=limit)
    twice = upsert(once, source, ["k"], profile=profile, broadcast_limit=limit)
    assert rows(twice) == rows(once) == [(1, "x"), (2, "y"), (3, "y")]


def test_profile(spark):
    data = [(1, None), (1, None), (2, "a"), (2, "a"), (2, "a"), (3, "b")]
    source = spark.createDataFrame(data, "a int, b string")
    profile = profile_source(source, ["a", "b"])
    assert (profile.rows, profile.null_key_rows, profile.most_rows_per_key) == (6, 2, 3)
    assert profile.key_bytes > 0
    assert profile_source(source.limit(0), ["a", "b"]) == SourceProfile(0, 0, 0, 0)


def test_repeated_source_key_is_an_error_but_null_keys_may_repeat(spark):
    lake = spark.createDataFrame([(1,)], "k int")
    twice = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(ValueError, match="up to 2 times"):
        upsert(lake, twice, ["k"], profile=profile_source(twice, ["k"]))
    nulls = spark.createDataFrame([(None,), (None,)], "k int")
    result = upsert(lake, nulls, ["k"], profile=profile_source(nulls, ["k"]))
    assert result.count() == 3


def test_empty_sides(spark, rows):
    full = spark.createDataFrame([(1, "x")], "k int, v string")
    empty = full.limit(0)
    assert rows(upsert(full, empty, ["k"])) == [(1, "x")]
    assert rows(upsert(empty, full, ["k"])) == [(1, "x")]


def test_result_has_the_columns_of_the_target(spark, rows):
    lake = spark.createDataFrame([(1, "x")], "k int, v string")
    wider = spark.createDataFrame([(9, "y", 2)], "extra int, v string, k int")
    assert rows(upsert(lake, wider, ["k"])) == [(1, "x"), (2, "y")]
    with pytest.raises(Exception, match="v"):
        upsert(lake, wider.drop("v"), ["k"]).collect()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_keys_leave_the_target_unshuffled(spark, tmp_path):
    for name in ("lake", "source"):
        spark.range(1000).selectExpr("id AS k", "id AS v").write.parquet(f"{tmp_path}/{name}")
    lake = spark.read.parquet(f"{tmp_path}/lake")
    source = spark.read.parquet(f"{tmp_path}/source")
    profile = profile_source(source, ["k"])

    small = plan(upsert(lake, source, ["k"], profile=profile))
    assert "BroadcastHashJoin" in small
    assert "Exchange hashpartitioning" not in small

    # The counted size decides, although these files look small to the optimizer.
    large = plan(upsert(lake, source, ["k"], profile=profile, broadcast_limit=0))
    assert "Broadcast" not in large
    assert large.count("Exchange hashpartitioning") == 2
    # Only rows with a key are read for the join, the others in a scan of their own.
    assert "PushedFilters: [IsNotNull(k)]" in large
    assert "PushedFilters: [IsNull(k)]" in large
    # The other side of the join carries nothing but the key.
    assert "ReadSchema: struct<k:bigint>" in large
