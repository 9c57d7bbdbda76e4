import os

import corpus_pipeline
import duckdb
import pytest
from medallion.llm.langid import every_fifth
from medallion.llm.queries import QUERIES, SQL
from pyspark.sql import functions as F

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    engine = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "labels"):
        engine.sql(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    expected = engine.sql(SQL[name])
    found = QUERIES[name](spark, SF_DIR)
    columns = sorted(found.columns)
    assert columns == sorted(expected.columns)
    places = [expected.columns.index(c) for c in columns]
    right = sorted((tuple(r[p] for p in places) for r in expected.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in columns) for r in found.collect()), key=repr) == right


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("op1_packing", "doc_id:bigint start:bigint length:bigint ids_crc32:bigint doc_tokens:bigint sequence_id:bigint offset:bigint"),
        ("op2_quality_classifier", "doc_id:bigint held_out:boolean score:double predicted:int"),
        ("op6_quality_rules", "doc_id:bigint n_words:bigint word_chars:bigint n_symbols:bigint n_dup_lines:bigint n_repeat_words:bigint base_failed:boolean kept:boolean"),
        ("op7_language_id", "doc_id:bigint held_out:boolean lang_pred:string score:double"),
        ("op8_minhash_near_dedup", "doc_id:bigint n_shingles:bigint component_id:bigint kept:boolean"),
        ("op12_spelling_variants", "word:string root:string form:string n:bigint n_near:bigint form_n:bigint"),
        ("op13_lexical_search", "item_id:bigint rank:int doc_id:bigint score:bigint"),
        ("op11_embedding_near_dedup", "vec_id:bigint n_links:bigint component_id:bigint kept:boolean"),
        ("op9_decontamination", "doc_id:bigint n_words:bigint n_hit:bigint n_items:bigint items_sha256:string contaminated:boolean"),
    ],
)
def test_columns_of_the_contract(spark, name, columns):
    found = QUERIES[name](spark, SF_DIR)
    kinds = dict(found.dtypes)
    assert {c: kinds[c] for c in (x.split(":")[0] for x in columns.split())} == dict(x.split(":") for x in columns.split())
    if "doc_id" not in columns.split()[0]:
        return
    rows = found.select(columns.split()[0].split(":")[0]).distinct().count()
    assert rows == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()


def test_pipeline_by_brute_force_of_its_stages(spark, odd, nothing, monkeypatch):
    """Each stage keeps what its operator's own (brute-force tested) verdict keeps."""
    from medallion.llm import decontamination, langid, neardup
    from medallion.llm.linefreq import drop_frequent_lines

    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "near_dedup", "decontaminate", "packing"]
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = langid.fit(docs, every_fifth(docs["doc_id"]))
    kept = stages["language_id"](spark, docs, SF_DIR).cache()
    wanted = langid.identify(docs, model).where("not rejected").select("doc_id")
    assert sorted(kept.select("doc_id").collect()) == sorted(wanted.collect()) and kept.columns == docs.columns
    cut = stages["line_dedup"](spark, kept, SF_DIR).cache()
    before = {r.doc_id: r.text for r in kept.collect()}
    whole = {
        r.doc_id: r.text if r.n_dropped < r.n_lines else before[r.doc_id]
        for r in drop_frequent_lines(kept).collect()
        if r.n_lines
    }
    assert {r.doc_id: r.text for r in cut.collect()} == whole
    assert cut.where("n_chars <> length(text)").count() == 0
    single = stages["near_dedup"](spark, cut, SF_DIR).cache()
    groups = neardup.near_duplicates(cut).collect()
    assert {r.doc_id for r in single.collect()} == {r.component_id for r in groups}
    clean = stages["decontaminate"](spark, single, SF_DIR).cache()
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    found = decontamination.judged(single, decontamination.matches(single, items))
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in found.collect() if not r.contaminated}
    packed = stages["packing"](spark, clean, SF_DIR)
    assert packed.select("doc_id").distinct().count() == clean.count()
    assert corpus_pipeline.run(spark, SF_DIR).agg(F.sum("length")).first() == packed.agg(F.sum("length")).first()


def test_stages_take_odd_and_empty_tables(spark, odd, nothing):
    for frame in (odd, nothing):
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, frame, SF_DIR)
            assert found.count() >= 0
            if name != "packing":
                assert found.columns == frame.columns


def test_a_third_of_copies_is_reduced_to_one_and_the_rest_stays(spark):
    def page(name, lines=6):
        return "\n".join(" ".join(f"{name}word{line}x{k}" for k in range(12)) for line in range(lines))

    rows = [(k, "s", "Home | About\n" + page(f"own{k}")) for k in range(40)]
    rows += [(100 + k, "s", "Home | About\n" + page("copied")) for k in range(20)] + [(200, "s", " \n"), (201, "s", None)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("n_chars", F.length("text").cast("long"))
    stages = dict(corpus_pipeline.STAGES)
    cut = stages["line_dedup"](spark, frame, SF_DIR).cache()
    assert {r.doc_id for r in cut.collect()} == {*range(40), *range(100, 120)}
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert all(texts[k] == page(f"own{k}") for k in range(40)) and texts[100] == dict((r[0], r[2]) for r in rows)[100]
    assert cut.where("n_chars <> length(text)").count() == 0
    single = stages["near_dedup"](spark, cut, SF_DIR)
    assert {r.doc_id for r in single.collect()} == {*range(40), 100} and single.columns == frame.columns


def test_copies_without_an_id_go_and_other_texts_without_one_stay(spark):
    a, b, c = (" ".join(f"{name}{k}" for k in range(40)) for name in "abc")
    rows = [(7, a), (None, a), (None, b), (None, c), (None, c), (9, a)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    single = corpus_pipeline.near_dedup(spark, frame, SF_DIR).collect()
    assert sorted(((r.doc_id, r.text) for r in single), key=repr) == sorted([(7, a), (None, b), (None, c)], key=repr)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_rows_that_share_an_id_are_told_apart_by_their_texts(spark, kind):
    """An id on a copy takes no other text with it; ids may be text and null."""
    a, b, c = (" ".join(f"{name}{k}" for k in range(40)) for name in "abc")
    rows = [(1, a), (2, a), (2, b), (None, c), (None, c), (5, c), (6, b + " more"), (8, a), (8, a), (9, "x y"), (9, "x y")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(f"cast(doc_id as {kind}) doc_id", "text")
    single = corpus_pipeline.near_dedup(spark, frame, SF_DIR).collect()
    name = str if kind == "string" else int
    expected = [(name(1), a), (name(2), b), (name(5), c), (name(9), "x y")]
    assert sorted((r.doc_id, r.text) for r in single) == sorted(expected)


def test_columns_named_like_the_figures_of_line_dedup_stay(spark):
    rows = [(k, "s", f"own line {k}\nshared", "keep", 77) for k in range(12)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string, n_lines string, n_dropped int")
    cut = corpus_pipeline.line_dedup(spark, frame.withColumn("n_chars", F.lit(0).cast("long")), SF_DIR).collect()
    assert {(r.text, r.n_lines, r.n_dropped) for r in cut} == {(f"own line {k}", "keep", 77) for k in range(12)}


def test_a_pipeline_run_leaves_only_what_its_result_reads(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder))
    packed = corpus_pipeline.run(spark, SF_DIR)
    left = set(os.listdir(folder)) - before
    assert [name.split("-")[2] for name in left] == ["decontaminate"]
    assert packed.count() > 0


def test_temporary_tables_go_even_after_an_error(spark):
    from medallion.llm.store import stored, temporary

    with pytest.raises(ZeroDivisionError), temporary(spark) as paths:
        made = stored(spark.range(10), "numbers", 2)
        assert made.count() == 10 and len(paths) == 1
        1 / 0
    assert not os.path.exists(paths[0])
    assert stored(spark.range(3), "kept").count() == 3
