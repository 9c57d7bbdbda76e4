"""Ranked lexical search: items against all documents, by scanning the texts.

Method: an Aho-Corasick automaton of all item terms, each between guards that stand for a
boundary, runs over every text once and counts the terms directly; there is no index of the
documents. The automaton's outputs are numbers of terms, which map to the items that have them.

The scan stores each text's length and counts of item terms. From these come the totals and the
documents of each term, which a second pass over the stored counts needs for the scores. It keeps
the best ``TOP`` of each item in a task, and a window over these gives the ranks.

Bounds: items are scanned in blocks of ``BLOCK_BYTES`` of terms, a scan for each, so the broadcast
automaton does not grow with the benchmark (an item alone is never divided). A task scores
``CELLS`` pairs of document and item together and keeps ``TOP`` documents per item of the block.

Defined cases: a null text or item, or one without a term, has no terms: it counts for nothing
and finds nothing; rows that share an id, and items that do, are ranked as separate ones; a
document with a null id comes after the others of its score; other columns are ignored; an empty
table on either side gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from medallion.llm.arrays import blocks, per_text, runs, utf8
from medallion.llm.store import size_of, stored

TOP = 10
BLOCK_BYTES = 4 << 20
CELLS = 1 << 21
GUARD = " "
TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NO_ID = np.iinfo(np.int64).max
#: Bytes of terms, with A-Z lower-cased; all others are the guard.
_FOLD = np.full(256, ord(GUARD), np.uint8)
_FOLD[48:58] = np.arange(48, 58)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def item_terms(text: Column) -> Column:
    """The distinct terms of an item."""
    folded = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_distinct(F.regexp_extract_all(folded, F.lit(TERM), F.lit(0)))


def automaton(terms: list[str]):
    """All terms between guards, with their numbers as output."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for number, term in enumerate(terms):
        found.add_word(f"{GUARD}{term}{GUARD}", number)
    found.make_automaton()
    return found


def scan(docs: DataFrame, terms: list[str]) -> DataFrame:
    """``id``, ``n`` (terms of the text), ``terms`` (numbers of those in it) and their ``tf``,
    of ``docs`` (id, text). Texts without any term are left out."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(shared.value)
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for first, end, part, bounds in blocks(data, offsets):
                folded = _FOLD[part]
                starts, _ = runs(folded != ord(GUARD), bounds)
                n = np.diff(per_text(starts, bounds))
                rows, numbers, counts = [], [], []
                for k in np.flatnonzero(n):
                    text = folded[bounds[k] : bounds[k + 1]].tobytes().decode("utf-8", "replace")
                    found = Counter(map(itemgetter(1), machine.iter(f"{GUARD}{text}{GUARD}")))
                    rows.append(first + k)
                    numbers.append(list(found))
                    counts.append(list(found.values()))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows, pa.int64())),
                        pa.array(n[n > 0], pa.int64()),
                        pa.array(numbers, pa.list_(pa.int32())),
                        pa.array(counts, pa.list_(pa.int32())),
                    ],
                    ["id", "n", "terms", "tf"],
                )

    return docs.mapInArrow(work, "id long, n long, terms array<int>, tf array<int>")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _best(item: np.ndarray, score: np.ndarray, ids: np.ndarray, top: int):
    """The first ``top`` of each item by score and id."""
    order = np.lexsort((ids, -score, item))
    item, score, ids = item[order], score[order], ids[order]
    place = np.arange(len(item)) - np.searchsorted(item, item, "left")
    kept = place < top
    return item[kept], score[kept], ids[kept]


def scored(hits: DataFrame, weights: np.ndarray, of: list[list[int]], n_docs: int, n_terms: int, top: int) -> DataFrame:
    """``item`` (its place in ``of``), ``id`` and ``score``: the best of each partition of
    ``hits``. ``of`` has the numbers of each item's terms."""
    context = hits.sparkSession.sparkContext
    items = np.repeat(np.arange(len(of)), [len(t) for t in of])
    terms = np.concatenate([np.array(t, np.int64) for t in of])
    order = np.argsort(terms, kind="stable")
    bounds = np.searchsorted(terms[order], np.arange(len(weights) + 1))
    shared = context.broadcast((weights, items[order], bounds, len(of)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, holders, bounds, count = shared.value
        best = tuple(np.empty(0, np.int64) for _ in range(3))
        least = np.zeros(count, np.int64)
        step = max(1, CELLS // count)
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                ids = part.column(0).fill_null(_NO_ID).to_numpy()
                m = np.array([10 + 90 * n * n_docs // n_terms for n in part.column(1).to_pylist()], np.int64)
                lengths = part.column(2).value_lengths().to_numpy()
                row = np.repeat(np.arange(part.num_rows), lengths)
                term = part.column(2).flatten().to_numpy().astype(np.int64)
                tf = part.column(3).flatten().to_numpy().astype(np.int64)
                share = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[row]))
                # a row of this for each item that has the term
                many = bounds[term + 1] - bounds[term]
                first = np.cumsum(many) - many
                at = np.arange(many.sum()) - np.repeat(first - bounds[term], many)
                total = np.zeros((part.num_rows, count), np.int64)
                np.add.at(total.reshape(-1), np.repeat(row, many) * count + holders[at], np.repeat(share, many))
                doc, item = np.nonzero((total >= least) & (total > 0))
                best = _best(
                    np.concatenate([best[0], item]),
                    np.concatenate([best[1], total[doc, item]]),
                    np.concatenate([best[2], ids[doc]]),
                    top,
                )
                full = np.bincount(best[0], minlength=count) == top
                last = np.searchsorted(best[0], np.arange(count), "right") - 1
                least[full] = best[1][last[full]]
        item, score, ids = best
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int64()), pa.array(ids, mask=ids == _NO_ID), pa.array(score)], ["item", "id", "score"]
        )

    return hits.select("id", "n", "terms", "tf").mapInArrow(work, "item long, id long, score long")


def search(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of the best documents of each item."""
    spark = docs.sparkSession
    texts = docs.select(docs[id_column].cast("long").alias("id"), docs[text_column].alias("text"))
    items = benchmark.select(benchmark[item_column].alias("item_id"), item_terms(benchmark[item_text]).alias("terms"))
    items = stored(items.where(F.size("terms") > 0), "items")
    wanted = max(1, math.ceil(size_of(items.select("terms")) / block_bytes))
    schema = StructType().add("item", LongType()).add(items.schema["item_id"])
    found = None
    for block in range(wanted):
        rows = items.where(F.pmod(F.xxhash64("item_id", "terms"), F.lit(wanted)) == block).collect()
        if not rows:
            continue
        terms = sorted({t for r in rows for t in r.terms})
        number = {t: k for k, t in enumerate(terms)}
        hits = stored(scan(texts, terms), "hits")
        n_docs, n_terms = hits.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs:
            break
        of_term = hits.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        df = np.zeros(len(terms), np.int64)
        for row in of_term.collect():  # a row for each term of the block
            df[row.term] = row.df
        weights = np.array([weight(n_docs, k) for k in df.tolist()], np.int64)
        best = scored(hits, weights, [[number[t] for t in r.terms] for r in rows], n_docs, n_terms, top)
        names = spark.createDataFrame([(k, r.item_id) for k, r in enumerate(rows)], schema)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        ranked = ranked.join(F.broadcast(names), "item").select(
            "item_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("doc_id"), "score"
        )
        found = ranked if found is None else found.union(ranked)
    if found is None:
        empty = StructType([items.schema["item_id"]]).add("rank", IntegerType())
        empty = empty.add("doc_id", LongType()).add("score", LongType())
        return spark.createDataFrame([], empty)
    return found
