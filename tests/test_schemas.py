"""Raw tables whose column types changed between batches."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from medallion.plans import RefinedState, TableSpec, read_raw, refine, refine_new
from medallion.sources.schemas import groups, wider
from pyspark.sql.types import _parse_datatype_string as parsed


@pytest.mark.parametrize(
    ("a", "b", "expected"),
    [
        ("int", "bigint", "bigint"),
        ("tinyint", "smallint", "smallint"),
        ("float", "double", "double"),
        ("smallint", "float", "float"),
        ("int", "double", "double"),
        ("int", "float", None),
        ("bigint", "double", None),
        ("decimal(10,2)", "decimal(12,2)", "decimal(12,2)"),
        ("decimal(10,2)", "decimal(9,4)", "decimal(12,4)"),
        ("decimal(38,2)", "decimal(38,10)", None),
        ("bigint", "decimal(10,2)", "decimal(21,2)"),
        ("date", "timestamp_ntz", "timestamp_ntz"),
        ("date", "timestamp", "timestamp"),
        ("timestamp", "timestamp_ntz", None),
        ("string", "int", None),
        ("void", "int", "int"),
        ("array<int>", "array<bigint>", "array<bigint>"),
        ("map<string,float>", "map<string,double>", "map<string,double>"),
        ("struct<a:int,b:string>", "struct<a:bigint,c:date>", "struct<a:bigint,b:string,c:date>"),
        ("struct<a:int>", "struct<a:string>", None),
    ],
)
def test_the_wider_type(spark, a, b, expected):
    for x, y in ((a, b), (b, a)):
        found = wider(parsed(x), parsed(y))
        if expected and expected.startswith("struct") and x == b:
            assert {f.name: f.dataType for f in found} == {f.name: f.dataType for f in parsed(expected)}
        else:
            assert (found and found.simpleString()) == expected


NARROW = "select 1 id, cast(0.5 as float) x, cast(1.25 as decimal(4,2)) d, date'2024-01-01' at"
WIDE = (
    "select 3000000000L id, 0.1d x, cast(12345.678 as decimal(9,3)) d, "
    "timestamp_ntz'2024-01-02 03:04:05' at, 'new' name"
)
ROWS = [
    (1, 0.5, Decimal("1.250"), datetime(2024, 1, 1), None),
    (3000000000, 0.1, Decimal("12345.678"), datetime(2024, 1, 2, 3, 4, 5), "new"),
]


@pytest.fixture
def raw(lake):
    return lake.table("raw", "shop", "t")


def test_batches_are_read_with_the_wider_types(spark, lake, raw, rows):
    for number, text in enumerate((NARROW, NARROW, WIDE)):
        raw.add_batch(spark.sql(text), "r", number)
    found = read_raw(lake, "shop", "t", from_events=False)
    assert found.dtypes == [
        ("id", "bigint"), ("x", "double"), ("d", "decimal(9,3)"), ("at", "timestamp_ntz"), ("name", "string"),
    ]
    assert rows(found) == sorted([ROWS[0], ROWS[0], ROWS[1]])
    assert rows(raw.read_batches(["run-r/batch-0", "run-r/batch-2"])) == rows(found)[1:]


def test_appended_files_are_read_with_the_wider_types(spark, lake, raw, rows):
    raw.append(spark.sql(NARROW))
    raw.append(spark.sql(WIDE))
    assert rows(read_raw(lake, "shop", "t", from_events=False)) == ROWS


def test_a_narrower_batch_is_an_error_that_names_it(spark, lake, raw, rows):
    raw.add_batch(spark.sql(WIDE), "r", 0)
    raw.add_batch(spark.sql(NARROW), "r", 1)
    with pytest.raises(ValueError, match="run-r/batch-1: id was bigint before and is only int"):
        read_raw(lake, "shop", "t", from_events=False)
    found = read_raw(lake, "shop", "t", from_events=False, narrower="widen")
    assert rows(found, "id", "x", "d", "at", "name") == ROWS


def test_types_without_a_common_one_are_an_error(spark, lake, raw):
    raw.add_batch(spark.sql("select 1 id"), "r", 0)
    raw.add_batch(spark.sql("select 'x' id"), "r", 1)
    with pytest.raises(ValueError, match="run-r/batch-1: id was int and is string"):
        read_raw(lake, "shop", "t", from_events=False)


def test_an_unfinished_batch_of_another_type_is_not_looked_at(spark, lake, raw, rows):
    raw.add_batch(spark.sql("select 1 id"), "r", 0)
    spark.sql("select 'x' id").write.parquet(f"{raw.path}/run-s/batch-0")
    assert rows(read_raw(lake, "shop", "t", from_events=False)) == [(1,)]


@pytest.mark.parametrize("only_new", [False, True])
@pytest.mark.parametrize("buckets", [0, 3])
def test_zones_take_the_wider_types(spark, lake, raw, rows, only_new, buckets):
    spec = TableSpec("shop", "t", ("id",), "at", ignore_columns=("d",), merge=True, buckets=buckets)
    state = RefinedState(lake.table("state", "refine", "batches"))
    for number, text in enumerate((NARROW, WIDE, WIDE.replace("3000000000L", "7L"))):
        raw.add_batch(spark.sql(text), "r", number)
        refine_new(lake, spec, state) if only_new else refine(lake, spec)
    for zone in ("safe", "trusted"):
        found = lake.table(zone, "shop", "t").read(all_columns=True)
        assert dict(found.dtypes)["id"] == "bigint" and dict(found.dtypes)["x"] == "double"
        assert rows(found, "id", "x", "at") == [
            (1, 0.5, datetime(2024, 1, 1)),
            (3000000000, 0.1, datetime(2024, 1, 2, 3, 4, 5)),
            (7, 0.1, datetime(2024, 1, 2, 3, 4, 5)),
        ]


def test_few_reads_find_the_groups(spark):
    asked = []

    def read(names):
        asked.append(names)
        kinds = {n < 90 for n in map(int, names)}
        if len(kinds) > 1:
            from pyspark.errors import AnalysisException

            raise AnalysisException("[CANNOT_MERGE_SCHEMAS]")
        return spark.range(0).selectExpr("id" if kinds == {True} else "id as x")

    found = groups([str(k) for k in range(128)], read)
    assert [len(g.names) for g in found] == [90, 38]
    assert len(asked) < 20


def test_dates_of_every_kind(spark):
    assert wider(parsed("date"), parsed("date")) == parsed("date") and date(2024, 1, 1)
