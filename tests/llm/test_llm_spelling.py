import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from medallion.llm import spelling
from medallion.llm.spelling import neighbour_keys, own_keys, variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def vocabulary(docs):
    total = Counter()
    for name, text in docs:
        for run in RUN.findall(text or ""):
            word = run.translate(LOWER)
            h = crc32(f"{'' if name is None else name}:{word}".encode())
            if h % 199 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            total[word] += 1
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def edits(word, letters):
    out = {word[:k] + word[k + 1 :] for k in range(len(word))}
    out |= {word[:k] + c + word[k + 1 :] for k in range(len(word)) for c in letters}
    out |= {word[:k] + c + word[k:] for k in range(len(word) + 1) for c in letters}
    return out - {word}


def brute(docs):
    words = vocabulary(docs)
    letters = {c for w in words for c in w}
    forms, near = {}, {}
    for w, n in words.items():
        near[w] = [v for v in edits(w, letters) if v in words]
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 5 * n else None

    def root(w):
        while forms[w]:
            w = forms[w]
        return w

    return {w: (root(w), forms[w], n, len(near[w]), words.get(forms[w])) for w, n in words.items()}


def found(frame, **options):
    return {r.word: (r.root, r.form, r.n, r.n_near, r.form_n) for r in variants(frame, **options).collect()}


@pytest.mark.parametrize("symbols", [2, 8])
def test_equals_brute_force_on_documents(spark, documents, symbols):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    expected = brute(docs)
    assert any(v[1] for v in expected.values())
    assert found(documents, symbols=symbols) == expected


def test_chains_ties_and_letters_beyond_ascii(spark):
    rng = random.Random(3)
    text = ["banana " * 5000 + "bananas " * 900 + "bananass " * 170 + "banänass " * 30 + "bänänass " * 6]
    text += ["Übergang übergang " * 3 + "schönes schÖnes " * 9 + "letter xetter " * 40 + "lettar " * 8]
    text += [" ".join("".join(rng.choice("abé") for _ in range(7)) for _ in range(4000))]
    text += ["aaaaaa aaaaaaa aaaaaaaa " * 7 + "× ÷÷÷÷÷÷ ×××××× " * 6, "long" * 2000 + " " + "lone" * 2000]
    docs = [(k, t) for k, t in enumerate(text)] + [(7, text[4])] * 5 + [(8, "long" * 1999 + "lonk " + "Long" * 2000)] * 6
    expected = brute(docs)
    assert expected["bänänass"][0] == "banana" and expected["lettar"][1] == "letter"
    assert found(spark.createDataFrame(docs, "doc_id long, text string")) == expected


def test_runs_that_lose_a_letter(spark):
    word = next(w for w in (f"question{chr(97 + k)}{chr(97 + j)}" for k in range(26) for j in range(26)) if crc32(f"4:{w}".encode()) % 199 == 0)
    docs = [(4, f"{word} {word.upper()} " * 5), (5, f"{word} " * 60)]
    expected = brute(docs)
    assert len(expected) == 2
    assert found(spark.createDataFrame(docs, "doc_id long, text string")) == expected


def test_odd_input(odd, nothing):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(odd) == brute(docs)
    assert found(nothing) == {}


def test_counts_that_are_handed_on_early(documents, monkeypatch):
    whole = found(documents)
    monkeypatch.setattr(spelling, "FLUSH_WORDS", 50)
    assert found(documents) == whole


@pytest.mark.parametrize("step", [1, 3, 1 << 18])
def test_neighbourhood_is_full_and_without_repeats(monkeypatch, step):
    rng = np.random.default_rng(2)
    monkeypatch.setattr(spelling, "SLICE", step * 20)
    rows = rng.integers(1, 4, (20, 7)).astype(np.uint64)
    got = [[] for _ in rows]
    for of, keys in neighbour_keys(rows, 3):
        for r, k in zip(of, keys, strict=True):
            got[r].append(int(k))
    for row, keys in zip(rows.tolist(), got, strict=True):
        word = tuple(row)
        strings = {word} | {word[:k] + word[k + 1 :] for k in range(7)}
        strings |= {word[:k] + (c,) + word[k + 1 :] for k in range(7) for c in (1, 2, 3)}
        strings |= {word[:k] + (c,) + word[k:] for k in range(8) for c in (1, 2, 3)}
        expected = {int(own_keys(np.array([s], np.uint64))[0]) for s in strings}
        assert len(keys) == len(set(keys)) == len(strings) and set(keys) == expected
