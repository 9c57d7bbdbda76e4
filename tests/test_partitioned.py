"""Tables in partitions: recoverable replacement, change of layout, buckets of the key."""

import re

import pytest
from medallion.plans import RefinedState, TableSpec, refine, refine_new
from medallion.sources import files
from medallion.sources.lake import ParquetTable
from medallion.sources.partitioned import PART, PartitionedTable
from pyspark.sql import DataFrameWriter

COLUMNS = "k string, id bigint, name string"


@pytest.fixture
def table(spark, folder):
    return PartitionedTable(spark, f"{folder('zone')}/people", ("k",))


@pytest.fixture
def people(spark):
    return lambda *values: spark.createDataFrame(values, COLUMNS)


@pytest.fixture
def broken(monkeypatch):
    """Let the writes into a table itself fail, after they have deleted what they replace."""

    def until(path, deleted=""):
        original = DataFrameWriter.parquet

        def write(self, target, *args, **options):
            if target == path:
                files.delete(self._spark, f"{path}/{deleted}")
                raise OSError("the executor is gone")
            return original(self, target, *args, **options)

        monkeypatch.setattr(DataFrameWriter, "parquet", write)
        return monkeypatch

    return until


def state(table, rows):
    return rows(table.read(), "k", "id", "name")


OLD = [("e", 1, "a"), ("e", 2, "b"), ("w", 3, "c")]


@pytest.mark.parametrize("again", ["recover", "replace", "merge"])
def test_a_replacement_that_stops_in_its_second_write_loses_no_row(table, people, rows, broken, again):
    table.replace(people(*OLD))
    new = [("e", 1, "x"), ("w", 3, "c"), ("w", 4, "d")]
    patch = broken(table.path)
    with pytest.raises(OSError):
        table.replace(people(*new))
    patch.undo()
    assert state(table, rows) == new and table.exists()
    if again == "recover":
        table.recover()
    elif again == "replace":
        table.replace(table.read())
    else:
        table.merge(people(("w", 9, "z")), ["k", "id"])
        new = [*new, ("w", 9, "z")]
    assert state(table, rows) == new
    assert table.pending() is None and table.stored_layout() == "k"


def test_partitions_that_were_not_written_again_are_taken_from_the_pending_copy(spark, table, people, rows):
    table.replace(people(*OLD))
    home = f"{table._beside('_pending')}/1"
    new = people(("e", 1, "x"), ("n", 5, "y")).withColumn(PART, table._part())
    new.write.partitionBy(PART).parquet(f"{home}/data")
    expected = [("e", 1, "x"), ("n", 5, "y"), ("w", 3, "c")]
    assert state(table, rows) == sorted(OLD)  # not marked as complete
    files.create_empty(spark, f"{home}/READY-parts-k")
    assert state(table, rows) == expected
    table.recover()
    assert state(table, rows) == expected and table.pending() is None


def test_a_copy_that_was_never_complete_is_dropped(spark, table, people, rows):
    table.replace(people(*OLD))
    people(("e", 7, "half")).write.parquet(f"{table._beside('_pending')}/1/data")
    table.merge(people(("w", 3, "z")), ["k", "id"])
    assert state(table, rows) == [("e", 1, "a"), ("e", 2, "b"), ("w", 3, "z")]
    assert not (spark.sparkContext._jvm.java.io.File(f"{table._beside('_pending')}/1").exists())


def test_a_merge_derived_from_a_pending_replacement(table, people, rows, broken):
    table.replace(people(*OLD))
    patch = broken(table.path, f"{PART}=ve")
    with pytest.raises(OSError):
        table.merge(people(("e", 2, "late")), ["k", "id"])
    patch.undo()
    table.merge(people(("e", 3, "new")), ["k", "id"])
    assert state(table, rows) == [("e", 1, "a"), ("e", 2, "late"), ("e", 3, "new"), ("w", 3, "c")]


def test_an_empty_replacement(table, people):
    table.replace(people(*OLD))
    table.replace(people(*OLD).limit(0))
    assert not table.exists()


def test_too_many_partitions_are_refused(spark, table, people, monkeypatch):
    monkeypatch.setattr("medallion.sources.partitioned.MOST_PARTS", 2)
    table.replace(people(*OLD))
    with pytest.raises(ValueError, match="too finely"):
        table.merge(people(*[(str(k), k, "x") for k in range(3)]), ["k", "id"])


def test_columns_or_buckets(spark):
    for options in ({}, {"columns": ("k",), "buckets": 4}):
        with pytest.raises(ValueError, match="either columns or buckets"):
            PartitionedTable(spark, "x/y", **options)
    base = {"namespace": "s", "dataset": "d", "table_key": ("k",)}
    with pytest.raises(ValueError, match="by columns or by buckets"):
        TableSpec(**base, partition_by=("k",), buckets=3)
    with pytest.raises(ValueError, match="Delta"):
        TableSpec(**base, buckets=3, storage_format="delta")


def test_a_delta_lake_refuses_partitions(spark, lake):
    from medallion.plans.refine import _zones
    from medallion.sources import Lake

    with pytest.raises(ValueError, match="Delta"):
        _zones(Lake(spark, lake.root, storage_format="delta"), spec(buckets=2))


LAKE = "id bigint, name string, phone string, at timestamp_ntz"


def spec(**changes):
    settings = {"merge": True, "ignore_columns": ("phone",), "checkpoint_column": "at"}
    return TableSpec("shop", "people", ("id",), **{**settings, **changes})


@pytest.fixture
def arrive(spark, lake):
    done = RefinedState(lake.table("state", "refine", "batches"))

    def bring(number, *ids, day=1, **changes):
        rows = [(k, f"n{number}", "p", None) for k in ids]
        frame = spark.createDataFrame(rows, LAKE).selectExpr(
            "id", "name", "phone", f"timestamp_ntz'2024-01-0{day}' as at"
        )
        lake.table("raw", "shop", "people").add_batch(frame, "r", number)
        refine_new(lake, spec(**changes), done)

    return bring


def held(lake, zone):
    found = lake.read(zone, "shop", "people").select("id", "name").collect()
    return sorted(map(tuple, found), key=str)


@pytest.mark.parametrize("cut", [False, True])
def test_a_change_of_layout_keeps_all_rows(spark, lake, arrive, cut):
    """To buckets, to other buckets, and back to none; ``cut``: raw no longer has the old rows."""
    arrive(0, 1, 2)
    expected = [(1, "n0"), (2, "n0")]
    for number, buckets in enumerate((4, 4, 3, 0, 2), 1):
        if cut:
            raw = lake.table("raw", "shop", "people")
            spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.fullyDelete(
                spark.sparkContext._jvm.java.io.File(f"{raw.path}/run-r")
            )
        arrive(number, 10 + number, buckets=buckets)
        expected.append((10 + number, f"n{number}"))
        for zone in ("safe", "trusted"):
            assert held(lake, zone) == sorted(expected, key=str)
            table = lake.table(zone, "shop", "people")
            layout = PartitionedTable(spark, table.path, buckets=9).stored_layout()
            assert layout == (f"{buckets} of key" if buckets else None)
            assert bool(table.versions()) == (buckets == 0)
            assert ("phone" in table.read().columns) == (zone == "safe")


def test_untouched_buckets_stay_and_are_not_scanned(spark, lake, arrive):
    arrive(0, *range(40), buckets=8)
    tables = [
        PartitionedTable(spark, lake.path(zone, "shop", "people"), buckets=8)
        for zone in ("safe", "trusted")
    ]
    before = [set(t._stored().inputFiles()) for t in tables]
    arrive(1, 7, day=2, buckets=8)
    for table, old in zip(tables, before, strict=True):
        new = set(table._stored().inputFiles())
        gone = {re.search(f"{PART}=b(\\d)/", f)[1] for f in old - new}
        assert len(gone) == 1 and len(old & new) >= 5
        assert {re.search(f"{PART}=b(\\d)/", f)[1] for f in new - old} == gone
        plan = table.read_parts([f"b{min(gone)}"])._jdf.queryExecution().executedPlan().toString()
        assert re.search(rf"PartitionFilters: \[[^]]*{PART}#\d+ = b\d", plan)
    assert (7, "n1") in held(lake, "trusted") and len(held(lake, "trusted")) == 40


def test_rows_without_a_key_are_kept_apart(spark, lake):
    rows = spark.createDataFrame([(1, "a", None, None), (None, "b", None, None)], LAKE)
    lake.write(rows, "raw", "shop", "people")
    for _ in range(2):
        refine(lake, spec(ignore_columns=(), checkpoint_column=None, buckets=4))
    found = held(lake, "trusted")
    assert found.count((1, "a")) == 1 and found.count((None, "b")) == 2
    parts = PartitionedTable(spark, lake.path("trusted", "shop", "people"), buckets=4)
    assert "n" in parts._parts_in(parts.path)


def test_a_wider_type_rewrites_all_partitions(spark, table, people, rows):
    table.replace(spark.sql("select 'e' k, 1 id, cast(0.5 as float) x"))
    table.merge(spark.sql("select 'w' k, 3000000000L id, 0.1d x, 'u' name"), ["k", "id"])
    table.merge(spark.sql("select 'w' k, 5 id, cast(2 as float) x, 'v' name"), ["k", "id"])
    assert table.read().dtypes == [("k", "string"), ("id", "bigint"), ("x", "double"), ("name", "string")]
    assert rows(table.read()) == [("e", 1, 0.5, None), ("w", 3000000000, 0.1, "u"), ("w", 5, 2.0, "v")]


def test_one_partitioned_table_reads_like_any_other(spark, table, people, rows):
    table.replace(people(*OLD))
    assert rows(ParquetTable(spark, table.path).read(), "k", "id", "name") == sorted(OLD)
