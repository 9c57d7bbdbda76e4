import hashlib
import random
import re

import pytest
from medallion.llm import decontamination as dc
from medallion.llm import store
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def brute(docs, items):
    out = {}
    for doc, text in docs:
        own, hit, named = words(text), set(), set()
        for item, passage in items:
            target = words(passage)
            size = min(13, len(target))
            windows = {tuple(target[k : k + size]) for k in range(len(target) - size + 1)} if target else set()
            for k in range(len(own) - size + 1):
                if tuple(own[k : k + size]) in windows:
                    hit.update(range(k, k + size))
                    named.add(item)
        ids = ",".join(sorted(str(x) for x in named if x is not None))
        known = [x for x in named if x is not None]
        flag = len(hit) > 0 and 20 * len(hit) >= len(own)
        out[doc] = (len(own), len(hit), len(known), hashlib.sha256(ids.encode()).hexdigest(), flag)
    return out


@pytest.fixture(scope="module")
def tables(spark):
    item = [f"t{k}" for k in range(30)]
    items = [
        (1, " ".join(item)),
        (2, "Short item, here"),
        (10, " ".join(item[10:25])),
        (3, "the the the the the the the the the the the the the the"),
        (4, None),
        (5, "!!"),
        (None, "nameless words stand here"),
        (6, "Short ITEM here"),
        (7, "never " + " ".join(item[:11]) + " seen"),
    ]
    docs = [
        (1, "a b " + " ".join(item[5:20]) + " c"),
        (2, " ".join(item)),
        (3, "short-item here and short item HERE"),
        (4, " ".join(item[:12])),
        (5, "the " * 40),
        (6, None),
        (7, ""),
        (8, "x " * 200 + " ".join(item[:13])),
        (9, " ".join(item) + " " + " ".join(item)),
        (10, "nameless words stand here"),
        (11, " ".join(item)),
    ]
    return (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        brute(docs, items),
    )


def brute_near(docs, items, span, size=13):
    """doc -> item -> the least number of words that hold all words of one of its windows."""
    out = {}
    for doc, text in docs:
        own = words(text)
        for item, passage in items:
            target = words(passage)
            length = min(size, len(target))
            bags = {frozenset(target[k : k + length]) for k in range(len(target) - length + 1)} if target else set()
            fits = [
                n
                for bag in bags
                for k in range(len(own))
                for n in range(len(bag), span + 1)
                if k + n <= len(own) and bag <= set(own[k : k + n])
            ]
            if fits:
                out.setdefault(doc, {})[item] = min(fits)
    return out


def result(docs, items, **options):
    found = dc.judged(docs, dc.matches(docs, items, **options)).collect()
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found}


@pytest.mark.parametrize("rarest", [1, 2, 4])
def test_hits_equal_brute_force(tables, rarest):
    docs, items, expected = tables
    assert result(docs, items, rarest=rarest) == expected
    assert [expected[k][4] for k in (1, 4, 8)] == [True, False, True]


def test_joined_instead_of_broadcast(tables, monkeypatch):
    monkeypatch.setattr(store, "BROADCAST_BYTES", -1)
    assert result(*tables[:2]) == tables[2]


def test_the_kept_documents_are_the_clean_ones(tables):
    docs, items, expected = tables
    kept = dc.without_contaminated(docs, dc.matches(docs, items))
    assert {r.doc_id for r in kept.collect()} == {k for k, v in expected.items() if not v[4]}


def test_no_python_in_the_plan(tables):
    docs, items, _ = tables
    plan = dc.judged(docs, dc.matches(docs, items))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_odd_rows(spark, odd, nothing):
    items = spark.createDataFrame([(1, "quick brown fox jumps")], "item_id long, text string")
    rows = dc.judged(odd, dc.matches(odd, items)).collect()
    assert len(rows) == 13 and sum(r.contaminated for r in rows) == 4
    assert dc.judged(nothing, dc.matches(nothing, items)).count() == 0
    assert not any(r.n_hit for r in dc.judged(odd, dc.matches(odd, items.limit(0))).collect())


def test_proximity_finds_scattered_words(texts, spark):
    docs = texts("zeta x alpha x x beta", "alpha " + "x " * 50 + "beta zeta", "beta alpha zeta beta alpha zeta", "alpha beta")
    items = spark.createDataFrame([(1, "alpha beta zeta")], "item_id long, text string")
    found = dc.proximity(docs, items, span=8).join(docs.select("doc_id", dc.text_key(docs["text"]).alias("key")), "key")
    assert {(r.doc_id, r.first, r.last) for r in found.collect() if r.doc_id == 0} == {(0, 0, 5)}
    assert {r.doc_id for r in found.collect()} == {0, 2}
    assert found.where("last - first >= 8").count() == 0 and found.select(F.max("first")).first()[0] <= 3


@pytest.mark.parametrize("limit", [64 << 20, -1])
def test_near_matches_equal_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(store, "BROADCAST_BYTES", limit)
    random.seed(5)
    item_rows = [(k, " ".join(random.choices([f"w{i}" for i in range(12)], k=random.randrange(1, 9)))) for k in range(30)]
    item_rows += [(30, " ".join(f"long{i}" for i in range(20))), (31, None), (None, "w1 w2"), (32, "w1 absent")]
    docs = [(k, " ".join(random.choices([f"w{i}" for i in range(40)], k=random.randrange(60)))) for k in range(60)]
    shuffled = [f"long{i}" for i in range(2, 15)]
    random.shuffle(shuffled)
    docs += [(60, "x " * 17 + " y ".join(shuffled[:7]) + " " + " ".join(shuffled[7:])), (61, " z z ".join(shuffled)), (62, None), (63, "")]
    docs.append((64, docs[60][1]))
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(item_rows, "item_id long, text string")
    expected = brute_near(docs, item_rows, 20)
    assert 60 in expected and 61 not in expected and len(expected) > 10
    rows = dc.searched(*frames, span=20).collect()
    named = {d: sorted(str(i) for i in found if i is not None) for d, found in expected.items()}
    assert {r.doc_id: (r.n_near_items, r.near_sha256) for r in rows} == {
        d: (len(named.get(d, [])), hashlib.sha256(",".join(named.get(d, [])).encode()).hexdigest()) for d, _ in docs
    }
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows} == brute(docs, item_rows)
    near = dc.proximity(*frames, span=20).withColumn("item", F.explode("item_ids")).groupBy("key", "item")
    near = near.agg(F.min(F.col("last") - F.col("first") + 1).alias("n"))
    near = near.join(frames[0].select("doc_id", dc.text_key(frames[0]["text"]).alias("key")), "key").collect()
    assert {(r.doc_id, r.item): r.n for r in near} == {
        (d, str(i)): n for d, found in expected.items() for i, n in found.items() if i is not None
    }


def test_documents_are_not_read_again_for_their_figures(tables, spark):
    docs, items, expected = tables
    twice = docs.union(docs).withColumn("id", F.lit("clash")).withColumn("key", F.lit(1))
    rows = dc.searched(twice, items)
    assert not re.search("split|regexp", rows._jdf.queryExecution().optimizedPlan().toString())
    found = [(r.doc_id, (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)) for r in rows.collect()]
    assert sorted(found) == sorted(list(expected.items()) * 2)
