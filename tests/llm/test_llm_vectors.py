import numpy as np
import pytest
from medallion.llm import vectors
from medallion.llm.vectors import distances, least_count, linked_pairs, merge, near_cells, near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.93):
    """vec_id, links, component and kept of rows with distinct ids."""
    good = [r for r in rows if r[1] and r[2] is not None and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    links = {r[0]: set() for r in rows}
    for a in good:
        for b in good:
            if a[0] != b[0] and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], np.float32).astype(float), np.array(b[1], np.float32).astype(float)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= cosine:
                    links[a[0]].add(b[0])
    out = {}
    for name in links:
        seen, queue = {name}, [name]
        while queue:
            for other in links[queue.pop()] - seen:
                seen.add(other)
                queue.append(other)
        out[name] = (len(links[name]), min(seen), min(seen) == name)
    return out


def found(frame, **options):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_vectors(frame, **options).collect()}


def clusters(count, size, dim=16, labels=2, spread=0.08, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(count):
        centre = rng.standard_normal(dim)
        for _ in range(size):
            v = centre + spread * np.linalg.norm(centre) * rng.standard_normal(dim) / np.sqrt(dim) * rng.integers(1, 6)
            rows.append((len(rows), [float(x) for x in v], c % labels))
    return rows


def test_equals_brute_force(spark):
    """In one block, and in cells, which may miss one in a thousand pairs at the very bound."""
    rows = clusters(25, 8) + [(1000 + k, r[1], r[2]) for k, r in enumerate(clusters(1, 150, seed=2))]
    expected, frame = brute(rows), spark.createDataFrame(rows, SCHEMA)
    links = sum(v[0] for v in expected.values())
    assert links > 1000
    assert found(frame) == expected
    routed = found(frame, leaf=60)
    assert all(routed[k][0] <= expected[k][0] for k in expected)
    assert sum(v[0] for v in routed.values()) >= 0.995 * links
    assert {k: v[1:] for k, v in routed.items()} == {k: v[1:] for k, v in expected.items()}


def test_routing_finds_pairs_at_the_bound(spark):
    """Many pairs at little more than the cosine, in cells of a sixteenth of the group."""
    rng = np.random.default_rng(4)
    rows = []
    for k in range(400):
        u = rng.standard_normal(32)
        u /= np.linalg.norm(u)
        e = rng.standard_normal(32)
        e -= (e @ u) * u
        v = 0.931 * u + np.sqrt(1 - 0.931**2) * e / np.linalg.norm(e)
        rows += [(2 * k, u.tolist(), 1), (2 * k + 1, (3.0 * v).tolist(), 1)]
    got = found(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), leaf=50)
    linked = sum(got[2 * k][0] == 1 and got[2 * k + 1][1] == 2 * k for k in range(400))
    assert linked >= 0.985 * 400


def pairs_at_the_bound(count, dim, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(count):
        u, e = rng.standard_normal((2, dim))
        u /= np.linalg.norm(u)
        e -= (e @ u) * u
        v = 0.9302 * u + np.sqrt(1 - 0.9302**2) * e / np.linalg.norm(e)
        rows += [(2 * k, u.tolist(), 1), (2 * k + 1, v.tolist(), 1)]
    return rows


@pytest.mark.parametrize("leaf", [40, 100])
def test_links_do_not_depend_on_the_size_of_a_label(spark, leaf):
    """The same rows in one cell and in many, and some of them with and without the others."""
    rows = pairs_at_the_bound(800, 32, 1) + [(5000 + r[0], r[1] * 2, 1) for r in clusters(20, 12, labels=1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    whole = found(frame)
    assert sum(v[0] for v in whole.values()) > 1600
    assert found(frame, leaf=leaf) == whole
    few = {k: v for k, v in whole.items() if k < 200}
    assert found(frame.where("vec_id < 200"), leaf=leaf) == few


def test_cells_lose_no_pair_and_leave_out_what_is_far():
    rows = clusters(40, 12, dim=24, labels=1) + pairs_at_the_bound(300, 24, 3)
    u = np.array([r[1] for r in rows])
    u /= np.linalg.norm(u, axis=1)[:, None]
    pivots = u[::9]
    own, near = near_cells(u, pivots, distances(pivots), 7, 0.93)
    a, b = np.nonzero(u @ u.T >= 0.93)
    assert (own[a] != own[b]).any() and len(set(own)) == 7
    assert near[a, own[b]].all()
    assert near.mean() < 0.8


def test_copies_are_one_class_and_count_each(spark):
    rows = [(k, [1.0, 2.0, 0.5], 3) for k in range(300)] + [(900, [2.0, 4.0, 1.0], 3), (901, [1.0, 2.0, 0.5], 4)]
    rows += [(902, [1.0, 2.0, 0.9], 3)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_odd_vectors(spark):
    rows = [
        (1, [1.0, 0.0], 1),
        (2, [1.0, 0.1], 1),
        (3, [0.0, 0.0], 1),
        (4, None, 1),
        (5, [1.0, None], 1),
        (6, [1.0, float("nan")], 1),
        (7, [float("inf"), 1.0], 1),
        (8, [], 1),
        (9, [1.0, 0.0, 0.0], 1),
        (10, [1.0, 0.0], None),
        (11, [3e38, 1e37], 1),
        (12, [1e-38, 0.0], 1),
        (13, [5.0], 2),
        (14, [7.0], 2),
        (15, [-7.0], 2),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as id", "1 as cls", "2 as n", "3 as kind", "4 as dim")
    assert found(frame) == brute(rows)
    assert found(frame.limit(0)) == {}


def test_rows_without_an_id_and_repeated_ids(spark):
    rows = [(None, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (5, [1.0, 0.01], 1), (None, [0.0, 1.0], 1)]
    got = [tuple(r) for r in near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()]
    key = [(None, 0, None, True), (None, 2, 5, False), (5, 2, 5, True), (5, 2, 5, True)]
    assert sorted(got, key=repr) == sorted(key, key=repr)


def test_crowded_cells_are_compared_in_blocks(spark, monkeypatch):
    rows = clusters(1, 200, labels=1, spread=0.02) + [(500 + r[0], r[1], 0) for r in clusters(6, 10, labels=1, seed=9)]
    monkeypatch.setattr(vectors, "CELLS", 500)
    monkeypatch.setattr(vectors, "PAIRS", 70)
    assert found(spark.createDataFrame(rows, SCHEMA), leaf=40) == brute(rows)


def test_least_count_is_a_quantile():
    p = 0.8663855974622838
    from math import comb

    def below(k):
        return sum(comb(32, j) * p**j * (1 - p) ** (32 - j) for j in range(k))

    k = least_count()
    assert below(k) <= 1e-4 < below(k + 1)


def test_counting_passes_what_the_cosine_confirms():
    rng = np.random.default_rng(8)
    x = rng.standard_normal((400, 8))
    sizes = np.linalg.norm(x, axis=1)
    got = {tuple(sorted(p)) for a, b in linked_pairs(x, x, (sizes, sizes), 0.93, True) for p in zip(a.tolist(), b.tolist(), strict=True)}
    near = (x @ x.T) / np.outer(sizes, sizes) >= 0.93
    expected = {(i, j) for i in range(400) for j in range(i + 1, 400) if near[i, j]}
    assert expected and got <= expected and len(got) >= 0.99 * len(expected)


def test_merge_joins_trees():
    root = np.arange(8)
    merge(root, np.array([5, 1, 6]), np.array([4, 2, 5]))
    merge(root, np.array([6]), np.array([2]))
    assert root.tolist() == [0, 1, 1, 3, 1, 1, 1, 7]
