import math
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from medallion.llm import langid, quality, secretscan
from pyspark.sql import functions as F


def counted(texts):
    rows = []
    for lang, text in texts:
        keys, n = np.unique(langid.symbols([text])[0], return_counts=True)
        rows.append(pd.DataFrame({"lang": lang, "key": keys.view(np.int64), "n": n}))
    return pd.concat(rows).groupby(["lang", "key"], as_index=False).sum()


def kneser_ney(text, vocabulary):
    """Interpolated Kneser-Ney by the definition, as a function of (context, symbol)."""
    row = "\0" * 3 + "".join(c if c.isalpha() else "\0" for c in text)
    top = Counter(row[k - 3 : k + 1] for k in range(3, len(row)))
    counts = {4: top}
    for n in (3, 2, 1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])

    def p(context, symbol):
        n = len(context) + 1
        lower = p(context[1:], symbol) if context else 1 / (vocabulary + 1)
        own = counts[n]
        once, twice = sum(c == 1 for c in own.values()), sum(c == 2 for c in own.values())
        d = min(max(once / max(once + 2 * twice, 1), 0.1), 0.95)
        total = sum(c for g, c in own.items() if g[:-1] == context)
        if not total:
            return lower
        kinds = sum(g[:-1] == context for g in own)
        return max(own[context + symbol] - d, 0) / total + d * kinds / total * lower

    return p


def test_probabilities_equal_the_definition():
    text = "the cat sat on the mat and the cat ran to the hat "
    model = langid.build(counted([("en", text)]))
    vocabulary = len(set(c if c.isalpha() else "\0" for c in text))
    p = kneser_ney(text, vocabulary)
    for probe in ("the cat", "zebra hat", "sat"):
        row = "\0" * 3 + "".join(c if c.isalpha() else "\0" for c in probe) + "\0"
        expected = [-math.log(p(row[k - 3 : k], row[k])) for k in range(3, len(row))]
        count, entropy = langid.cross_entropies(model, [probe])
        assert count[0] == len(expected)
        assert entropy[0, 0] == pytest.approx(np.mean(expected), rel=1e-9)


def test_texts_do_not_touch_in_a_block():
    model = langid.build(counted([("en", "some words here"), ("de", "andere worte dort")]))
    probes = ["here", None, "worte!", "", "Some  Words", "12", "a\0b"]
    together = langid.cross_entropies(model, probes)
    for k, probe in enumerate(probes):
        alone = langid.cross_entropies(model, [probe])
        assert together[0][k] == alone[0][0]
        assert np.allclose(together[1][k], alone[1][0])


def test_languages_of_the_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs, langid.every_fifth(docs["doc_id"]))
    found = langid.identify(docs, model).join(docs, "doc_id").where(langid.every_fifth(F.col("doc_id")))
    right, total, rejected = found.agg(
        F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*"), F.sum(F.col("rejected").cast("int"))
    ).first()
    assert right >= 0.98 * total and rejected <= 0.01 * total
    lang, score, rejected = langid.decide(model, ["Привет, как дела сегодня " * 9, "qxzj kwvq zxxq jqkj " * 9, None])
    assert rejected.all() and lang[2] == "und" and score[2] == 0


def test_odd_languages(odd, nothing):
    model = langid.fit(odd, F.lit(False))
    rows = langid.identify(odd, model, columns=tuple(odd.columns)).collect()
    assert len(rows) == 13
    assert all((r.lang_pred == "und") == (r.doc_id in (3, 4, 5, 8) or r.text is None) for r in rows)
    assert langid.fit(nothing, F.lit(False)) is None
    assert {r.lang_pred for r in langid.identify(odd, None).collect()} == {"und"}
    assert langid.identify(nothing, model).count() == 0


def test_rare_grams_are_counted_and_learning_texts_are_bounded(spark):
    """A language of many rare grams keeps them all; few long texts are bounded by characters."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(6)
    rows = [(k, "".join(map(chr, 0x4E00 + rng.integers(0, 20_000, 400))), "zh") for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    never = F.lit(False)
    whole = langid.fit(docs, never)
    assert len(whole.grams[-1][0]) > 100_000
    fewer = langid._learning(docs, never, ("doc_id", "text", "lang"), 20_000, 40_000).count()
    assert 60 <= fewer <= 150


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.fit(docs, labels, quality.third_of_four(labels["doc_id"]))
    found = quality.score(docs, model).join(labels, "doc_id").where(quality.third_of_four(F.col("doc_id"))).toPandas()
    good, bad = found[found.quality == 1].score.to_numpy(), found[found.quality == 0].score.to_numpy()
    assert (good[:, None] > bad[None, :]).mean() > 0.95
    assert ((found.score >= 0.7) == (found.quality == 1)).mean() > 0.93


def test_quality_of_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 0), (7, None), (10, 0), (None, 1)], "doc_id long, quality int")
    model = quality.fit(odd, labels, F.lit(False))
    rows = quality.score(odd, model).collect()
    assert len(rows) == 13 and all(0 <= r.score <= 1 for r in rows)
    assert quality.fit(odd, labels.limit(0), F.lit(False)) is None
    assert {r.score for r in quality.score(odd, None).collect()} == {0.5}
    assert quality.score(nothing, model).count() == 0


def test_word_vectors_hold_their_contexts():
    column = pa.array(["red apple sweet", None, "", "red apple sour"])
    index = quality.index_vectors(quality.WORDS, 0)
    total = np.zeros_like(index)
    quality.contexts(column, index, total)
    (t,) = quality._token_blocks(column)
    red, apple, sweet, _, _, sour = t.word
    assert np.allclose(total[red], 2 * index[apple] + index[sweet] + index[sour])
    assert np.allclose(total[apple], 2 * index[red] + index[sweet] + index[sour])


def test_temperature_lowers_the_loss():
    random = np.random.default_rng(0)
    x = random.normal(size=(400, 5))
    y = (x[:, 0] + random.normal(size=400) > 0).astype(float)
    net = quality.train(x[:100], y[:100], epochs=200)

    def loss():
        p = np.clip(net.probabilities(x[100:]), 1e-9, 1 - 1e-9)
        return -np.mean(y[100:] * np.log(p) + (1 - y[100:]) * np.log(1 - p))

    before = loss()
    quality.temper(net, x[100:], y[100:])
    assert loss() <= before and ((net.probabilities(x[100:]) > 0.5) == y[100:]).mean() > 0.6


SECRETS = [
    'set token = "%040x" now' % (k * 7919**9 % 16**40) for k in range(60)
] + [f"card {4 * 10**15 + k * 7919} paid" for k in range(60)] + [f"mail user{k}.{k}@mail{k}.example.com" for k in range(60)]


def test_secrets_are_told_from_other_findings(texts):
    docs = texts(*SECRETS, None, "").withColumn("source", F.lit("src"))
    found = secretscan.scan(docs).collect()
    assert len(found) >= 180
    assert {r.doc_id for r in found if r.is_secret} == set(range(60))
    assert all(r.is_secret == (r.label == 1) for r in found)


def test_given_labels_are_learned(texts):
    docs = texts(*SECRETS).withColumn("source", F.lit("src"))
    labels = secretscan.scan(docs).select("doc_id", "place", F.col("doc_id").between(60, 119).cast("int").alias("label"))
    found = secretscan.scan(docs, labels=labels).collect()
    assert {r.doc_id for r in found if r.is_secret} == set(range(60, 120))


def test_no_findings_or_one_kind(odd, nothing, texts):
    assert secretscan.scan(nothing).count() == 0
    assert secretscan.scan(odd).where("is_secret").count() == 0
    one = texts("number 4000123412341234 only").withColumn("source", F.lit(None).cast("string"))
    assert [r.probability for r in secretscan.scan(one).collect()] == [0.0]


def test_no_python_in_the_secret_plan(texts):
    plan = secretscan.scan(texts(*SECRETS).withColumn("source", F.lit("s")))._jdf.queryExecution().toString()
    assert "Arrow" not in plan and "Python" not in plan


def test_every_value_of_a_token_is_a_candidate(texts):
    key = "ghp_" + "1a2b3c4d5e" * 3
    values = [f"{k:016d}" for k in range(500)]
    docs = texts(
        'see {"description":"configuration-settings","token":"%s","github_access_token":"%s"} now' % (key, key + "9"),
        ",".join(values),
        f"a\u2028{values[1]}\u0085;{values[2]} next",
        f'name = "{key}" end',
        "configuration-settings;1;administration-panel",
    ).withColumn("source", F.lit("s"))
    found = secretscan.candidates(docs, "doc_id", "source", "text").collect()
    of = {k: sorted((r for r in found if r.id == k), key=lambda r: r.part) for k in range(5)}
    assert [r.value for r in of[0]] == [key, key + "9"] and [r.part for r in of[0]] == [0, 1]
    assert of[0][0].lead == 'configuration-settings","token":"'
    assert of[0][1].lead == 'github_access_token":"'
    assert [r.value for r in of[1]] == values and [r.part for r in of[1]] == list(range(500))
    assert [r.value for r in of[2]] == values[1:3] and of[2][1].after == "next"
    assert [(r.place, r.part, r.value, r.lead, r.before, r.after) for r in of[3]] == [(2, 0, key, '"', "name =", "end")]
    assert of[4] == []
    scanned = secretscan.scan(docs).collect()
    assert len({(r.doc_id, r.place, r.part) for r in scanned}) == len(scanned) == len(found)


def test_labels_name_a_value_of_a_token(texts):
    docs = texts(*(f'x:"{k:020d}";token:"{k + 500:020d}"' for k in range(120))).withColumn("source", F.lit("s"))
    labels = secretscan.scan(docs).select("doc_id", "place", "part", F.col("part").cast("int").alias("label"))
    found = secretscan.scan(docs, labels=labels).collect()
    assert len(found) == 240 and all(r.is_secret == (r.part == 1) == (r.label == 1) for r in found)
    first = secretscan.scan(docs, labels=labels.where("part = 0").drop("part")).collect()
    assert {(r.part, r.label) for r in first} == {(0, 0.0), (1, None)}


def test_dictionary_coverage(texts):
    docs = texts("apple apple apple river", "see applezriver-apple-0123456789 apple river")
    docs = docs.withColumn("source", F.lit("s"))
    found = secretscan.candidates(docs, "doc_id", "source", "text")
    words = secretscan.dictionary(docs, found, "text", 2)
    row = secretscan.features(found, words).first()
    assert row.value == "applezriver-apple-0123456789"
    assert row.f_coverage == pytest.approx(5 / 28) and row.f_length == 28


def test_copies_of_a_secret_are_not_words(texts):
    secret = "Qwertyuiop-Zxcvbnm/Lkjhgf7dsapoiu"
    frame = texts(*[f"key = {secret} end"] * 5, "plain qwertyuiop", "other qwertyuiop zxcvbnm zxcvbnm")
    docs = frame.selectExpr("doc_id", "text", "'p' as path")
    found = secretscan.candidates(docs, "doc_id", "path", "text")
    words = secretscan.dictionary(docs, found, "text", 2)
    assert {r.word for r in words.collect()} == {"qwertyuiop"}


def test_a_repeated_labelled_id_does_not_widen_the_sample(spark, monkeypatch):
    rows = [(7, f"text number {k} of one id") for k in range(600)] + [(7, "the same text")] * 300
    rows += [(1000 + k, f"another text {k}") for k in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    labels = spark.createDataFrame([(r, r % 2) for r in [7, *range(1000, 1500)]], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "_fit", lambda sample: seen.append(sample.select("id", "text").collect()))
    quality.fit(docs, labels, F.lit(False), max_texts=100)
    assert len(seen[0]) == len(set(seen[0])) == 100
    assert 30 <= sum(r.id == 7 for r in seen[0]) <= 80
    quality.fit(docs, labels, F.lit(False))
    assert len(seen[1]) == len(set(seen[1])) == 1101


def test_vectors_and_forward_pass_in_plain_python():
    """The pooled vector and the probability, token by token, without blocks or matrix tricks."""
    texts = ["The cat  saw THE Cat 42 times!!, iPhone10 e-mail\nthe", "", None, "...", "a", "x1x1 über Ünder 2024-01-02"]
    words = np.random.default_rng(1).normal(size=(quality.WORDS, quality.WIDTH)).astype(np.float32)
    def kind(byte):
        return int(quality._KIND[byte])

    def expected(text):
        data, found = (text or "").encode(), []
        for at, byte in enumerate(data):
            if at and kind(byte) == kind(data[at - 1]) and kind(byte):
                found[-1][1] = at + 1
            elif kind(byte):
                found.append([at, at + 1])
        parts = [np.zeros(quality.WIDTH) for _ in range(4)]
        last = {}
        for k, (start, end) in enumerate(found):
            token, own = data[start:end], kind(data[start])
            folded = np.frombuffer(token.lower(), np.uint8)
            (hashed,) = quality.hash_runs(folded, np.array([0]), np.array([len(folded)]))
            size = min(int(math.log2(len(token))), 5)
            capitals = sum(65 <= b <= 90 for b in token)
            case = 0 if not capitals else 2 if capitals == len(token) else 1 if 65 <= token[0] <= 90 else 3
            other = 64 + 6 * (token[0] % 24) + min(len(token), 6) - 1
            shape = {1: 4 * size + case, 2: 32 + size}.get(own, other)
            glued = k > 0 and found[k - 1][1] == start
            before = kind(data[found[k - 1][0]]) if k else 0
            name = bytes(folded)
            distance = min(int(math.log2(k - last[name])), 11) + 1 if name in last else 0
            last[name] = k
            parts[0] += words[int(hashed) % quality.WORDS]
            parts[1] += quality._SHAPE_VECTORS[shape]
            parts[2] += quality._JOIN_VECTORS[8 * glued + 4 * (own > 1) + before]
            parts[3] += quality._DISTANCE_VECTORS[distance + 13 * (own == 3)]
        return [v for part in parts for v in part / max(len(found), 1)] + [math.log1p(len(found))]

    made = np.vstack(list(quality.vectors(pa.array(texts), words)))
    plain = [expected(text) for text in texts]
    assert np.allclose(made, plain, atol=1e-5)

    chance = np.random.default_rng(2)
    width, hidden = made.shape[1], 3
    net = quality.Network(
        chance.normal(size=width), chance.uniform(1, 2, width), chance.normal(0, 0.1, (width, hidden)),
        chance.normal(size=hidden), chance.normal(size=hidden), 0.3, 1.7,
    )
    for row, probability in zip(made.tolist(), net.probabilities(made), strict=True):
        inner = [
            math.tanh(sum((v - m) / s * w for v, m, s, w in zip(row, net.mean, net.scale, column, strict=True)) + b)
            for column, b in zip(net.first.T, net.bias, strict=True)
        ]
        logit = sum(h * w for h, w in zip(inner, net.second, strict=True)) + net.offset
        assert probability == pytest.approx(1 / (1 + math.exp(-logit / net.temperature)), rel=1e-6)
