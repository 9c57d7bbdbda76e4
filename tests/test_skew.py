"""Keys that hold a third of the rows each."""

import pytest
from medallion.operators import profile_source, upsert

ROWS = 300_000
SETTINGS = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k",
}


@pytest.fixture
def settings(spark):
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    yield
    for name in SETTINGS:
        spark.conf.unset(name)


@pytest.mark.parametrize("guard", [None, "at"])
def test_upsert_into_a_target_with_a_hot_key_and_no_keys(spark, tmp_path, settings, guard):
    key = "CASE id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'hot' ELSE md5(CAST(id AS string)) END"
    lake_rows = spark.range(0, ROWS, 1, 16)
    lake_rows.selectExpr("id", f"{key} AS key", "0 AS at").write.parquet(f"{tmp_path}/lake")
    source_rows = spark.range(0, ROWS // 3, 1, 4)
    source_rows.selectExpr(
        "-id AS id", "md5(CAST(id * 3 + 2 AS string)) AS key", "1 AS at"
    ).write.parquet(f"{tmp_path}/source")
    lake = spark.read.parquet(f"{tmp_path}/lake")
    source = spark.read.parquet(f"{tmp_path}/source")

    profile = profile_source(source, ["key"])
    result = upsert(lake, source, ["key"], guard, profile, broadcast_limit=0)
    result.write.parquet(f"{tmp_path}/out")
    written = spark.read.parquet(f"{tmp_path}/out")
    counts = {
        r.kind: r["count"]
        for r in written.selectExpr(
            "CASE WHEN at = 1 THEN 'new' ELSE coalesce(nullif(key, 'hot'), 'x') END AS kind"
        ).groupBy("kind").count().collect()
    }
    assert counts == {"new": ROWS // 3, "x": 2 * ROWS // 3}

    ids = result.select("id")
    assert len(ids.collect()) == ROWS
    assert "skew=true" in ids._jdf.queryExecution().executedPlan().toString()
