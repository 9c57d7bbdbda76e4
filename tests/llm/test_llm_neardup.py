import random
import re
from itertools import combinations

import numpy as np
import pytest
from medallion.llm import neardup, store
from medallion.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    if not words:
        return set()
    return {tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1))}


def brute(rows):
    sets = [(k, shingles(t)) for k, t in rows]
    parent = {k: k for k, _ in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for (a, x), (b, y) in combinations(sets, 2):
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {k: (len(s), root(k), root(k) == k) for k, s in sets}


def found(frame):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(frame).collect()}


def edited(words, edits):
    words = list(words)
    for _ in range(edits):
        at = random.randrange(len(words))
        words[at : at + 1] = random.choice([[], [f"e{random.random()}"], [words[at], f"i{random.random()}"]])
    return words


@pytest.fixture(scope="module")
def copies():
    """Groups of copies with few to many edits, around a passage that all of them share."""
    random.seed(2)
    passage = [f"p{k}" for k in range(40)]
    rows = []
    for group in range(6):
        base = [f"g{group}w{random.randrange(300)}" for _ in range(random.choice([30, 90, 150]))] + passage
        rows += [" ".join(edited(base, random.randrange(9))) for _ in range(25)]
    rows += [" ".join(passage + [f"u{k}x{i}" for i in range(random.randrange(80))]) for k in range(40)]
    rows += ["A b", "a B", "a", None, "", " ", rows[0], rows[0].upper()]
    return list(enumerate(rows))


def test_components_equal_brute_force(spark, copies):
    frame = spark.createDataFrame(copies, "doc_id long, text string")
    expected = brute(copies)
    assert found(frame) == expected
    assert 20 < sum(not kept for *_, kept in expected.values()) < 200


def test_blocks_of_few_classes_give_the_same(spark, copies, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 3)
    monkeypatch.setattr(store, "BROADCAST_BYTES", -1)
    assert found(spark.createDataFrame(copies, "doc_id long, text string")) == brute(copies)


def test_open_pages_of_a_template(spark, monkeypatch):
    """Pages that share much, but too little, cost no comparisons; those within the bound are found."""
    random.seed(5)
    template = [f"t{k}" for k in range(330)]
    rows = [" ".join(template + [f"u{k}x{i}" for i in range(80)]) for k in range(600)]
    near = [f"n{k}" for k in range(300)]
    rows += [" ".join(near + [f"v{k}x{i}" for i in range(30 + k % 30)]) for k in range(60)]
    compared = []
    original = neardup._compared

    def counted(members, units, sets):
        compared.append(units.count())
        return original(members, units, sets)

    monkeypatch.setattr(neardup, "_compared", counted)
    rows = list(enumerate(rows))
    expected = brute(rows)
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == expected
    assert all(k == component for k, (_, component, _) in expected.items() if k < 600)
    assert compared[0] <= 60


def test_blocks_are_bounded_by_shingles(spark, copies, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK_VALUES", 400)
    monkeypatch.setattr(neardup, "PAIRS", 7)
    assert found(spark.createDataFrame(copies, "doc_id long, text string")) == brute(copies)
    units = spark.createDataFrame([(1, 300), (1, 500), (1, 1), (2, 1)], "unit long, n long")
    assert {r.unit: r.blocks for r in neardup._counted(units).collect()} == {1: 3, 2: 1}


def test_union_sketches_by_definition():
    chance = random.Random(3)
    pairs = []
    for _ in range(300):
        size = chance.choice([3, 40, 64])
        x = sorted(chance.sample(range(200), size))
        y = sorted({v if chance.random() < chance.random() else v + 1000 for v in x})
        pairs.append((x, y))
    rows = [neardup._sketch_rows(neardup.pa.array(side)) for side in zip(*pairs, strict=True)]
    at = np.arange(len(pairs))
    expected = []
    for x, y in pairs:
        union = sorted({*x, *y})[: neardup.SKETCH]
        both = len(set(x) & set(y) & set(union))
        expected.append(both >= neardup.LEAST_ESTIMATE * len(union))
    assert neardup._suggested(*rows, at, at).tolist() == expected
    assert 0 < sum(expected) < 300


def test_the_test_table(documents):
    assert found(documents) == brute([(r.doc_id, r.text) for r in documents.collect()])


def test_odd_rows(odd, nothing):
    rows = neardup.near_duplicates(odd).collect()
    assert len(rows) == 13
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by_id[1].component_id == 1 and by_id[2].component_id == 1 and not by_id[2].kept
    assert all(by_id[k].component_id == k and by_id[k].n_shingles == 0 and by_id[k].kept for k in (3, 4, 5))
    assert neardup.near_duplicates(nothing).count() == 0


def test_intersections_by_columns(monkeypatch):
    monkeypatch.setattr(neardup, "COLUMNS", 3)
    random_ = np.random.default_rng(1)
    sets = [[np.unique(random_.integers(0, 30, random_.integers(0, 20))) for _ in range(6)] for _ in range(2)]
    expected = [[len(set(x) & set(y)) for y in sets[1]] for x in sets[0]]
    assert neardup._intersections(*sets).tolist() == expected


def test_paths_and_stars_become_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3), (139, 60)]
    made = components(spark.createDataFrame(edges, "a long, b long")).collect()
    label = {r.node: r.component for r in made}
    assert label == {**{k: 0 for k in range(1, 41)}, **{k: 60 for k in range(100, 140)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
