import random
import re
from collections import Counter, defaultdict

import pytest
from medallion.llm.linefreq import drop_frequent_lines
from medallion.llm.qualityrules import FIGURES, apply_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def norm(line):
    return " ".join(WORD.findall(line)).translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


@pytest.fixture(scope="module")
def pages(spark):
    random.seed(4)
    lines = ["Home | About", "home  | about ", "", "  ", "Terms"] + [f"line number {k}" for k in range(40)]
    rows = [
        (k, random.choice(["a", "a", "b", None, ""]), "\n".join(random.choices(lines, [9, 9, 4, 4, 9] + [1] * 40, k=8)))
        for k in range(120)
    ]
    return spark.createDataFrame(rows, "doc_id long, source string, text string"), rows


def test_lines_above_the_ratio_go(pages):
    frame, rows = pages
    hosts, count = Counter(), Counter()
    for _, host, text in rows:
        hosts[host or ""] += 1
        count.update((host or "", x) for x in {norm(line) for line in text.split("\n")} if x)
    expected = {}
    for doc, host, text in rows:
        lines = text.split("\n")
        bad = [(n := count[host or "", norm(x)]) >= 3 and n > 0.2 * hosts[host or ""] for x in lines]
        kept = [x for x, b in zip(lines, bad, strict=True) if not b]
        expected[doc] = ("\n".join(kept), sum(bool(norm(x)) for x in lines), sum(bad))
    found = drop_frequent_lines(frame, ratio=0.2).collect()
    assert {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in found} == expected
    assert sum(x[2] for x in expected.values()) > 100


def test_the_joined_form_equals_the_broadcast_one(pages, monkeypatch):
    from medallion.llm import linefreq

    small = sorted(map(tuple, drop_frequent_lines(pages[0], ratio=0.2).collect()), key=repr)
    monkeypatch.setattr(linefreq, "BROADCAST_LINES", -1)
    assert sorted(map(tuple, drop_frequent_lines(pages[0], ratio=0.2).collect()), key=repr) == small


def test_odd_rows(odd, nothing):
    found = drop_frequent_lines(odd)
    assert found.count() == 13 and set(odd.columns) <= set(found.columns)
    assert {r.n_dropped for r in found.collect()} == {0}
    assert drop_frequent_lines(nothing).count() == 0


def figures(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    covered = {i for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for i in range(k, k + 8)}
    seen, repeats = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            repeats += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, repeats, len(covered)


def test_base_figures_by_brute_force(documents, odd):
    for frame in (documents, odd):
        found = apply_rules(frame).collect()
        expected = sorted((r.doc_id is None, r.doc_id, *figures(r.text)) for r in frame.collect() if r.doc_id is not None)
        assert sorted((False, r.doc_id, *(r[c] for c in FIGURES)) for r in found if r.doc_id is not None) == expected
        for r in found:
            assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
            assert not (r.kept and r.base_failed)


def test_documents_made_of_common_lines_are_depleted(spark):
    common = [" ".join(f"c{k}w{i}" for i in range(10)) for k in range(3)]
    rows = [(k, "s", "\n".join([*common, " ".join(f"own{k}w{i}" for i in range(60))])) for k in range(30)]
    rows += [(100 + k, "s", "\n".join([*common, f"tail {k}"])) for k in range(5)]
    rows += [(200 + k, "t", "\n".join([*common, f"tail {k}"])) for k in range(5)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string")
    found = {r.doc_id: r for r in apply_rules(frame).collect()}
    count = defaultdict(set)
    for doc, host, text in rows:
        for line in text.split("\n"):
            count[host, line].add(doc)
    for doc, host, text in rows:
        limit = max(20, 0.02 * sum(h == host for _, h, _ in rows))
        removed = sum(len(line.split()) for line in text.split("\n") if len(count[host, line]) > limit)
        total = len(text.split())
        assert found[doc].n_removed == removed
        assert found[doc].kept == (total - removed >= 0.3 * total)
    assert [found[k].kept for k in (0, 100, 200)] == [True, False, True]


def test_no_documents(nothing):
    assert apply_rules(nothing).count() == 0
