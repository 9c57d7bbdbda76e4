import random
from collections import defaultdict

import numpy as np
import pytest
from medallion.llm import substrings
from medallion.llm.arrays import blocks, hash_runs, per_text, runs, utf8, window_hashes


def prose(random_, words):
    syllables = "ka lo mi tu re san de vor el in ga pe".split()
    return " ".join("".join(random_.choices(syllables, k=random_.randint(1, 4))) for _ in range(words))


def test_chunks_cover_a_text_and_survive_insertions():
    random_ = random.Random(3)
    text = prose(random_, 4000).encode()
    data = np.frombuffer(text, np.uint8)
    ends = substrings.chunk_ends(data, np.array([0, len(data)]))
    assert ends[-1] == len(data) and (np.diff(np.append(0, ends)) > 0).all()
    assert np.diff(np.append(0, ends)).max() <= substrings.MOST

    def parts(raw):
        found = substrings.chunk_ends(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        return {raw[a:b] for a, b in zip(np.append(0, found[:-1]), found, strict=True)}

    changed = text[:9000] + b"inserted words" + text[9000:]
    assert len(parts(text) - parts(changed)) <= 6


def test_chunks_of_a_block_are_those_of_each_text():
    random_ = random.Random(5)
    raw = [prose(random_, n).encode() for n in (50, 1, 300)] + [b"a " * 400, "äß".encode() * 300]
    bounds = np.append(0, np.cumsum([len(r) for r in raw]))
    together = substrings.chunk_ends(np.frombuffer(b"".join(raw), np.uint8), bounds).tolist()
    apart = []
    for start, r in zip(bounds, raw, strict=False):
        own = substrings.chunk_ends(np.frombuffer(r, np.uint8), np.array([0, len(r)]))
        apart += [int(start + e) for e in own]
        assert all(r[:e].decode() is not None for e in own)
    assert together == apart


@pytest.fixture(scope="module")
def planted():
    random_ = random.Random(8)
    passages = [prose(random_, 55) for _ in range(5)]
    line = prose(random_, 9)
    rows = []
    for k in range(120):
        words = [prose(random_, random_.randint(30, 200)), line]
        if k % 3 == 0:
            words.insert(random_.randint(0, 2), passages[k % 5])
        rows.append((k, "\n".join(words)))
    rows += [(500, rows[3][1]), (501, "de " * 60 + prose(random_, 40)), (502, prose(random_, 30) + " de" * 60)]
    return rows, passages


def test_planted_passages_are_found_and_clean_texts_left_alone(spark, planted, monkeypatch):
    rows, passages = planted
    first = {}
    expected = set()
    for doc, text in rows:
        for p in passages:
            if p in text:
                if p in first:
                    expected.add(doc)
                first.setdefault(p, doc)
    expected |= {502}
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = substrings.repeated_passages(frame)
    assert {r.doc_id for r in found.collect()} == expected
    texts = dict(rows)
    for r in found.collect():
        assert r.source_doc_id < r.doc_id and r.n_words >= 20
        own = texts[r.doc_id].encode()[r.start : r.start + r.length].decode()
        known = [p for p in [*passages, "de " * 50] if p in texts[r.doc_id]]
        assert r.doc_id == 500 or any(p[k : k + 100] in own for p in known for k in range(len(p) - 99))
    rest = {r.doc_id: r.text for r in substrings.without_passages(frame, found).collect()}
    assert len(rest) == len(rows) and all(rest[k] == texts[k] for k in texts if k not in expected)
    assert all(len(rest[k]) < len(texts[k]) - 150 for k in expected if k < 500)
    monkeypatch.setattr(substrings, "BROADCAST_DIGESTS", -1)
    again = substrings.repeated_passages(frame)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, found.collect()))


def covered(rows, found):
    """The bytes of each text that lie in its passages, as a mask."""
    masks = {k: np.zeros(len(text.encode()), bool) for k, text in rows}
    for r in found:
        assert r.source_doc_id < r.doc_id and r.n_words >= 20
        masks[r.doc_id][r.start : r.start + r.length] = True
    return masks


def test_nested_adjoining_and_divided_copies_are_found_whole(spark):
    random_ = random.Random(12)
    x, y, whole = prose(random_, 55), prose(random_, 55), prose(random_, 54).split()
    thirds = [" ".join(whole[k : k + 18]) for k in (0, 18, 36)]
    whole = " ".join(whole)

    def among(passage):
        return f"{prose(random_, 30)} {passage} {prose(random_, 30)}"

    rows = [(1, among(x)), (2, among(f"{x} {y}")), (3, among(f"{x} {y}"))]
    rows += [(10 + k, among(third)) for k, third in enumerate(thirds)] + [(20, among(whole)), (21, among(whole))]
    lines = [prose(random_, 9) for _ in range(4)]
    rows += [(30 + k, among(line)) for k, line in enumerate(lines)] + [(40, among(" ".join(lines)))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    passages = substrings.repeated_passages(frame)
    found = passages.collect()
    assert {r.doc_id for r in found} == {2, 3, 21}
    assert {(r.doc_id, r.source_doc_id) for r in found} == {(2, 1), (3, 1), (3, 2), (21, 20)}
    masks, texts = covered(rows, found), dict(rows)
    for doc, passage in ((2, x), (3, f"{x} {y}"), (21, whole)):
        start = texts[doc].encode().index(passage.encode())
        inside = masks[doc][start : start + len(passage.encode())]
        assert inside[substrings.MOST : -substrings.MOST].all()
    for r in found:
        assert texts[r.doc_id].encode()[r.start : r.start + r.length] in texts[r.source_doc_id].encode()
    rest = {r.doc_id: r.text for r in substrings.without_passages(frame, passages).collect()}
    assert not any(part in rest[3] for part in (x[80:-80], y[80:-80])) and rest[40] == texts[40]


def test_windows_cover_each_common_run_of_chunks_by_brute_force(spark):
    random_ = random.Random(31)
    parts = [prose(random_, random_.randint(8, 30)) for _ in range(12)]
    rows = [(k, " ".join(random_.choices(parts, k=6))) for k in range(25)]
    rows += [(30, "a " * 300), (31, "b" * 3000 + " a" * 200), (32, "")]
    split = {}
    for doc, text in rows:
        data = np.frombuffer(text.encode(), np.uint8)
        ends = substrings.chunk_ends(data, np.array([0, len(data)])).tolist()
        split[doc] = [(a, b, text.encode()[a:b]) for a, b in zip([0, *ends], ends, strict=False)]
    expected = {}
    for doc, text in rows:
        mask = np.zeros(len(text.encode()), bool)
        own = [c for *_, c in split[doc]]
        for other in split:
            theirs = [c for *_, c in split[other]]
            for i in range(len(own) if other < doc else 0):
                for j in range(len(theirs)):
                    n = 0
                    while i + n < len(own) and j + n < len(theirs) and own[i + n] == theirs[j + n]:
                        n += 1
                    if n and len(b"".join(own[i : i + n]).split()) >= 20:
                        mask[split[doc][i][0] : split[doc][i + n - 1][1]] = True
        expected[doc] = mask
    found = substrings.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    masks = covered(rows, found)
    assert all((masks[k] == expected[k]).all() for k in expected)
    assert sum(m.sum() for m in expected.values()) > 3000


def test_odd_rows(odd, nothing):
    found = substrings.repeated_passages(odd)
    assert {(r.doc_id, r.source_doc_id) for r in found.collect()} == {(2, 1)}
    assert substrings.without_passages(odd, found).count() == 13
    assert substrings.repeated_passages(nothing).count() == 0


def test_array_helpers_against_plain_python():
    import pyarrow as pa

    texts = ["ab  cd", None, "", "ab", " x ab cd ab", "é é"]
    data, offsets = utf8(pa.array(["skip", *texts]).slice(1))
    assert [data[a:b].tobytes().decode() for a, b in zip(offsets, offsets[1:], strict=False)] == [t or "" for t in texts]
    seen = defaultdict(set)
    for first, _, part, bounds in blocks(data, offsets, 5):
        starts, ends = runs(part != 32, bounds)
        at = per_text(starts, bounds)
        hashes = hash_runs(part, starts, ends)
        for k in range(len(bounds) - 1):
            words = [part[a:b].tobytes().decode() for a, b in zip(starts[at[k] : at[k + 1]], ends[at[k] : at[k + 1]], strict=True)]
            assert words == (texts[first + k] or "").split()
            for word, h in zip(words, hashes[at[k] : at[k + 1]], strict=True):
                seen[word].add(int(h))
    assert all(len(v) == 1 for v in seen.values()) and len({min(v) for v in seen.values()}) == len(seen)
    values = np.arange(1, 8, dtype=np.uint64)
    assert len(window_hashes(values, 5, 1)) == 3 and len(window_hashes(values, 9, 1)) == 0
