import json

import pytest
from medallion.cli import _group_sources, main, parser
from medallion.plans import CheckpointState
from medallion.sources import Lake

EVENTS = "id bigint, phone string, at timestamp_ntz"


@pytest.fixture
def people(spark):
    spark.sql(
        "SELECT id, concat('555-', id) AS phone, timestamp_ntz'2024-01-01' AS at FROM range(1, 6)"
    ).createOrReplaceTempView("cli_people")
    yield "cli_people"
    spark.catalog.dropTempView("cli_people")


def test_table_to_topic_to_zones(spark, tmp_path, people):
    root, topic = f"{tmp_path}/", f"{tmp_path}/topic"
    where = ["--namespace", "shop", "--dataset", "people"]
    main(
        ["capture", "--root", root, "--database", "db", "--table", people, "--topic", topic],
        spark,
    )
    main(
        ["ingest-events", "--root", root, *where, "--topic", topic, "--schema", EVENTS,
         "--progress", f"{tmp_path}/progress"],
        spark,
    )
    refine = ["refine", "--root", root, *where, "--table-key", "id", "--checkpoint-column", "at",
              "--ignore-columns", "phone", "--merge", "--topic", topic, "--schema", EVENTS]
    main(refine, spark)
    main([*refine, "--only-new"], spark)
    trusted = Lake(spark, root).read("trusted", "shop", "people")
    assert trusted.columns == ["id", "at", "key", "timestamp_kafka"]
    assert sorted(r.id for r in trusted.collect()) == [1, 2, 3, 4, 5]


def test_ingest_table_keeps_a_checkpoint(spark, tmp_path, people):
    root = f"{tmp_path}/"
    for _ in range(2):
        main(
            ["ingest-table", "--root", root, "--namespace", "shop", "--dataset", people,
             "--checkpoint-column", "at"],
            spark,
        )
    lake = Lake(spark, root)
    assert lake.read("raw", "shop", people).count() == 10
    assert CheckpointState(lake.table("state", "ingest", "checkpoints")).read().count() == 1


def test_configured_run_reports_the_tables_that_failed(spark, tmp_path, people):
    tables = {people: {"key": ["id"], "checkpoint_column": "at"}, "cli_none": {"key": ["id"]}}
    config = tmp_path / "tables.json"
    config.write_text(json.dumps({"group": {"connection": "shop", "tables": tables}}))
    with pytest.raises(SystemExit, match="cli_none"):
        main(
            ["run", "--root", f"{tmp_path}/", "--config", str(config),
             "--progress", f"{tmp_path}/progress"],
            spark,
        )
    assert Lake(spark, f"{tmp_path}/").read("trusted", "shop", people).count() == 5


def test_groups_read_from_databases_of_their_own(spark):
    groups = {
        "one": {"connection": "shop", "url": "jdbc:x://a/shop", "options": {"user": "u"}, "tables": {}},
        "two": {"connection": "crm", "url": "jdbc:y://b/crm", "driver": "D", "tables": {}},
        "three": {"connection": "erp", "tables": {}},
    }
    args = parser().parse_args(
        ["run", "--root", "x", "--config", "c", "--progress", "p", "--url", "jdbc:z://c/erp",
         "--driver", "E", "--option", "fetchsize=5", "--split", "t:id:4"]
    )
    sources = _group_sources(spark, args, groups)
    assert set(sources) == {"shop", "crm"}
    assert (sources["shop"].url, sources["crm"].url) == ("jdbc:x://a/shop", "jdbc:y://b/crm")
    assert (sources["shop"].driver, sources["crm"].driver) == ("E", "D")
    assert sources["shop"].options == {"fetchsize": "5", "user": "u"}
    assert sources["crm"].splits["t"].tasks == 4


def test_count_words(spark, tmp_path, rows):
    (tmp_path / "text").write_text("a b a\nb a\n")
    main(["count-words", "--input", f"{tmp_path}/text", "--output", f"{tmp_path}/out"], spark)
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == [("a", 3), ("b", 2)]
