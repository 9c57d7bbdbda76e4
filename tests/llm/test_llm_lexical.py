import math
import re
from collections import Counter

import pytest
from medallion.llm.lexical import search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=10):
    counts = [(name, Counter(terms(text))) for name, text in docs]
    counts = [(name, c, sum(c.values())) for name, c in counts if c]
    n_docs, total = len(counts), sum(n for _, _, n in counts)
    out = []
    for item, text in items:
        wanted = set(terms(text))
        weights = {
            t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in c for _, c, _ in counts) + 1)))
            for t in wanted
        }
        scores = []
        for name, c, n in counts:
            m = 100 - 90 + 90 * n * n_docs // total
            score = sum(weights[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in wanted if t in c)
            if score > 0:
                scores.append((-score, name is None, name or 0, name))
        scores.sort()
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(scores[:top])]
    return sorted(out, key=repr)


def found(docs, items, **options):
    return sorted((tuple(r) for r in search(docs, items, **options).collect()), key=repr)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")


@pytest.mark.parametrize("block_bytes", [1 << 22, 4000])
def test_equals_brute_force_on_documents(documents, benchmark, block_bytes):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    got = found(documents, benchmark, block_bytes=block_bytes)
    assert len(got) > 300 and got == brute(docs, items)


def test_boundaries_ties_and_repeated_terms(spark):
    docs = [(9, "alpha beta"), (3, "Alpha,BETA"), (5, "alphabeta alpha-beta_beta"), (4, "béta\x00beta9 9 ünder"), (1, "!!")]
    docs += [(20 + k, "filler words only here") for k in range(30)] + [(2, None), (8, "alpha beta " * 30_000)]
    items = [(1, "ALPHA beta; alpha"), (2, "béta 9 beta9 und"), (3, None), (4, "..."), (5, "alphab"), (6, "filler")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = found(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert got == brute(docs, items)
    assert [r[2] for r in sorted(got) if r[0] == 6] == list(range(20, 30))


def test_items_that_share_an_id_and_odd_documents(spark, odd, nothing):
    items = spark.createDataFrame(
        [(1, "the quick fox"), (1, "word1 another2"), (None, "ein eine äöü"), (7, "1234 two")], "item_id long, text string"
    ).selectExpr("*", "'x' as terms", "1 as item", "2 as n")
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(odd, items) == brute(docs, [(r.item_id, r.text) for r in items.collect()])
    assert found(nothing, items) == [] and found(odd, items.limit(0)) == []


def test_fewer_documents_are_kept_per_task_than_scored(spark):
    docs = [(k, "common " * (1 + k % 7) + f"rare{k % 3}") for k in range(500)]
    items = [(k, f"common rare{k}") for k in range(3)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = found(frame, spark.createDataFrame(items, "item_id long, text string"), top=4)
    assert got == brute(docs, items, 4)
