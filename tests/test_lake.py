import pytest
from medallion.sources import DeltaTable, Lake, new_scratch, staged
from medallion.sources import files
from medallion.sources.lake import merge_statement
from pyspark.sql import functions as F


@pytest.fixture
def table(lake):
    return lake.table("trusted", "shop", "items")


def frame(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id int")


def ids(df):
    return sorted(r.id for r in df.collect())


def test_paths(spark):
    assert Lake(spark).path("raw", "shop", "items") == "s3a://prd-lake-raw-shop/items"
    staging = Lake(spark, "hdfs:///x/", "STAGING")
    assert staging.path("safe", "shop", "items") == "hdfs:///x/stg-lake-safe-shop/items"
    with pytest.raises(ValueError, match="TEST"):
        Lake(spark, environment="TEST").path("raw", "shop", "items")


def test_modes(spark, lake):
    lake.write(frame(spark, 1), "raw", "shop", "items")
    lake.write(frame(spark, 1, 2), "raw", "shop", "items", mode="append")
    assert ids(lake.read("raw", "shop", "items")) == [1, 1, 2]
    lake.write(frame(spark, 3), "raw", "shop", "items", mode="overwrite")
    lake.write(frame(spark, 4), "raw", "shop", "items")
    assert ids(lake.read("raw", "shop", "items")) == [3, 4]
    with pytest.raises(ValueError, match="ignore"):
        lake.write(frame(spark, 5), "raw", "shop", "items", mode="ignore")


def test_a_missing_table_is_an_error_to_readers(table):
    assert not table.exists()
    with pytest.raises(Exception, match="(?i)path"):
        table.read()


def test_a_table_can_be_replaced_from_itself(spark, table):
    table.append(frame(spark, 1, 2, 3))
    for _ in range(3):
        table.replace(table.read().filter("id > 1"))
    assert ids(table.read()) == [2, 3]
    assert [v.name for v in table.versions()] == ["00000001", "00000002", "00000003"]


def test_a_failed_replacement_leaves_the_table(spark, table):
    table.replace(frame(spark, 1, 2))
    broken = table.read().withColumn("id", F.raise_error(F.lit("boom")).cast("int"))
    with pytest.raises(Exception, match="boom"):
        table.replace(broken)
    assert ids(table.read()) == [1, 2]
    table.replace(frame(spark, 7))
    assert ids(table.read()) == [7]


def test_an_unfinished_version_is_not_read(spark, table):
    table.append(frame(spark, 1))
    frame(spark, 9).write.parquet(f"{table.path}/_versions/00000001")
    assert ids(table.read()) == [1]
    table.replace(frame(spark, 2))
    assert ids(table.read()) == [2]
    assert [v.name for v in table.versions()] == ["00000002"]


def test_a_frame_read_before_a_replacement_stays_valid(spark, table):
    table.replace(frame(spark, 1))
    old = table.read()
    table.replace(frame(spark, 2))
    assert ids(old) == [1]


def test_a_repeated_batch_replaces_itself_and_mixes_with_appends(spark, table):
    table.append(frame(spark, 0))
    table.add_batch(frame(spark, 1, 2), "a", 0)
    table.add_batch(frame(spark, 3), "a", 1)
    table.add_batch(frame(spark, 1, 2), "a", 0)
    table.add_batch(frame(spark, 4), "b", 0)
    assert ids(table.read()) == [0, 1, 2, 3, 4]
    assert table.read().columns == ["id"]


def test_expire_removes_what_was_replaced_and_never_the_current(spark, table):
    table.append(frame(spark, 1))
    table.add_batch(frame(spark, 2), "a", 0)
    assert table.expire(hours=0) == []
    assert ids(table.read()) == [1, 2]
    table.replace(frame(spark, 3))
    table.replace(frame(spark, 4))
    frame(spark, 9).write.parquet(f"{table.path}/_versions/00000003")
    assert table.expire() == []
    gone = table.expire(hours=0)
    assert {"00000001", "00000003", "run-a"} <= set(gone)
    assert [e.name for e in files.entries(spark, f"{table.path}/_versions/_commits")
            if not e.name.startswith(".")] == ["00000002"]
    assert ids(table.read()) == [4]
    table.replace(frame(spark, 5))
    assert ids(table.read()) == [5]


def test_first_merge_loads_and_later_ones_update(spark, table, rows):
    one = spark.createDataFrame([(1, "a"), (2, "a")], "id int, v string")
    two = spark.createDataFrame([(2, "b"), (3, "b")], "id int, v string")
    table.merge(one, ["id"])
    table.merge(two, ["id"])
    assert rows(table.read()) == [(1, "a"), (2, "b"), (3, "b")]


def test_merge_can_take_columns_out_of_the_target(spark, table, rows):
    table.replace(spark.createDataFrame([(1, "secret"), (2, "secret")], "id int, phone string"))
    table.merge(frame(spark, 2, 3), ["id"], drop=["phone"])
    assert table.read().columns == ["id"]
    assert ids(table.read()) == [1, 2, 3]


def test_scratch_lies_in_the_shared_folder_and_is_removed(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert new_scratch(spark, "x").startswith(shared)
    assert new_scratch(spark, "x") != new_scratch(spark, "x")
    with staged(spark, frame(spark, 1, 2), "x") as stored:
        path = stored.inputFiles()[0].rsplit("/", 1)[0]
        assert ids(stored) == [1, 2]
        assert files.entries(spark, path)
    assert files.entries(spark, path) == []


def test_delta_is_chosen_by_format_and_merges_by_statement(spark):
    lake = Lake(spark, storage_format="delta")
    assert isinstance(lake.table("raw", "shop", "items"), DeltaTable)
    assert merge_statement("/t", "s", ["a", "b"]) == (
        "MERGE INTO delta.`/t` AS lake USING s AS source "
        "ON lake.`a` = source.`a` AND lake.`b` = source.`b` "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )
    guarded = merge_statement("/t", "s", ["a"], "at")
    assert "lake.`at` IS NULL OR source.`at` >= lake.`at`" in guarded
