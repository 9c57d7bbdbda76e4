"""Documents to packed token sequences, stage by stage.

Each stage takes what the one before it kept, as Parquet, and its decisions take effect: texts
whose language is rejected go, boilerplate lines are cut, one document of each group of near
copies stays, documents that contain benchmark passages go, and the rest is packed.

A row stands for a document, also where rows share an id: decisions are by row or by text. Ids
may be of any type that can be ordered, or null. Null and empty texts go in the first stage.
Columns beyond those of ``documents`` are carried along.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.llm import decontamination, langid
from medallion.llm.linefreq import drop_frequent_lines
from medallion.llm.neardup import near_duplicates
from medallion.llm.packing import pack
from medallion.llm.store import broadcast_within, free, ship, stored, temporary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that ``lang`` names."""
    ship(spark)
    model = langid.fit(docs, langid.every_fifth(docs["doc_id"]))
    found = langid.identify(docs, model, columns=tuple(docs.columns))
    return found.where("not rejected").select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their source's boilerplate lines. One that has no other lines keeps
    them: it may be one of many copies, which are for the next stage to reduce."""
    columns = docs.columns
    whole = free("_before", columns)
    # the operator's figures have names that a column of the documents may have too
    own = {c: free(f"_own_{c}", columns) for c in ("n_lines", "n_dropped") if c in columns}
    cut = drop_frequent_lines(docs.withColumnsRenamed(own).withColumn(whole, F.col("text")))
    cut = cut.where("n_lines > 0")
    cut = cut.withColumn("text", F.when(F.col("n_dropped") < F.col("n_lines"), F.col("text")).otherwise(F.col(whole)))
    cut = cut.drop("n_lines", "n_dropped").withColumnsRenamed({v: k for k, v in own.items()})
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of the least id, where rows without an
    id come last. Rows that share an id are told apart by their texts; of those that are equal
    in both, one stays."""
    ship(spark)
    columns, key = docs.columns, free("_key", docs.columns)
    name = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"))
    docs = docs.withColumn(key, name)
    found = stored(near_duplicates(docs, id_column=key).where("n_shingles > 0"), "found")
    copies = found.where("not kept").select(F.col(key).alias("_copy")).distinct()
    copies = broadcast_within(stored(copies, "copies"))
    left = docs.join(copies, docs[key] == copies["_copy"], "left_anti")
    # the few rows that are equal in id and text: their key stands several times among those kept
    again = found.where("kept").groupBy(key).agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    again = broadcast_within(stored(again.select(F.col(key).alias("_again")), "again"))
    once = left.join(again, left[key] == again["_again"], "left_anti")
    repeated = left.join(again, left[key] == again["_again"], "left_semi").dropDuplicates([key])
    return once.select(columns).union(repeated.select(columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages are less than a twentieth of."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.without_contaminated(docs, decontamination.matches(docs, benchmark))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with the columns of ``pack``."""
    ship(spark)
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

#: No SQL: the first stage is a language model and the last a tokenizer.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next reads it. What a stage
    wrote besides its result, and the result before it, are deleted then."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before: list[str] = []
    for name, stage in STAGES[:-1]:
        with temporary(spark) as paths:
            docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
            result = paths.pop()
            paths += before
        before = [result]
    return STAGES[-1][1](spark, docs, sf_dir)
