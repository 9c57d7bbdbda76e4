"""Language identification by interpolated Kneser-Ney character models.

Method: one character model of order four per language. Counts of four-grams over the
learning texts give continuation counts for the lower orders; every order is discounted
absolutely and interpolated with the next lower one. The models of all languages share sorted
arrays of 64-bit hashes, one per order, with a column of log probabilities per language, so a
character costs one binary search; back-off weights stand in arrays of their own. A text gets
the language of lowest cross-entropy per character. On learning texts kept out of the counts,
one factor calibrates the posterior, and a cutoff per language on the deviation from its usual
cross-entropy calibrates the rejection.

Learning is distributed: texts are counted in the executors, and only the counts that make up
the models reach the driver. Two documented bounds hold for fitting alone: ``max_texts`` per
language (chosen by a hash of the id) and ``max_grams`` per language (the most frequent).
Every text is scored whole.

Defined cases: a null text or one without a letter is ``und`` with score 0 and is rejected;
null languages are not learned; with nothing to learn every text is ``und``; other columns are
ignored; repeated rows are separate texts.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructType

from medallion.llm.arrays import mix
from medallion.llm.store import free

if TYPE_CHECKING:  # workers do without it
    import pandas as pd

ORDER = 4
UNKNOWN = "und"
BLOCK_CHARS = 1 << 19
FEW = 20  # calibration texts of a language
LEAST_EXCESS = 0.5  # nats per character above the usual, without which nothing is rejected
_GAP = "\0" * (ORDER - 1)
_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        known = [unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)]
        _letters.append(np.array(known))
    return _letters[0]


@dataclass
class Model:
    """``grams[n]`` and ``backs[n]`` hold hashes of n symbols and a row of values for each:
    the log probability of the last symbol, and the log weight of backing off from them."""

    languages: list[str]
    grams: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    backs: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    floor: np.ndarray | None = None
    sharpness: float = 1.0
    usual: np.ndarray | None = None  # mean cross-entropy, two variance terms, cutoff


def symbols(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Four-symbol keys of all scored characters and the text each belongs to.

    Letters are lower-cased; a run of anything else is one boundary, scored where it follows a
    letter. The first character of a text has boundaries before it.
    """
    joined = _GAP + _GAP.join((t or "").replace("\0", " ") for t in texts).lower() + _GAP
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter, gap = _letter_table()[points], points == 0
    after = np.empty(len(points), bool)
    after[0] = False
    after[1:] = letter[:-1]
    scored = letter | after
    kept = scored | gap
    text_of = np.cumsum(gap)[scored & kept]
    folded = ((points ^ points >> np.uint32(16)) & np.uint32(0xFFFF)).astype(np.uint64)
    folded[~letter] = 0
    row, places = folded[kept], np.flatnonzero(scored[kept])
    keys = np.zeros(len(places), np.uint64)
    for back in range(ORDER):
        keys |= row[places - back] << np.uint64(16 * back)
    # a scored gap symbol belongs to the text before it
    return keys, (text_of - gap[scored & kept]) // (ORDER - 1) - 1


def _mask(n: int) -> np.uint64:
    return np.uint64((1 << 16 * n) - 1)


def _find(table: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``hashes`` in the sorted ``table`` and whether they are there."""
    if not len(table):
        return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
    at = np.searchsorted(table, hashes)
    at[at == len(table)] = 0
    return at, table[at] == hashes


def build(counts: pd.DataFrame) -> Model:
    """Models from the columns ``lang``, ``key`` (four symbols) and ``n``."""
    model = Model(sorted(counts["lang"].unique()))
    width = len(model.languages)
    raw = []  # per order, per language: keys, counts
    top = []
    for lang in model.languages:
        own = counts[counts["lang"] == lang]
        keys = own["key"].to_numpy().astype(np.int64).view(np.uint64)
        order = np.argsort(keys)
        top.append((keys[order], own["n"].to_numpy(np.float64)[order]))
    raw.append(top)
    for n in range(ORDER - 1, 0, -1):
        lower = []
        for keys, _ in raw[-1]:
            below, continued = np.unique(keys & _mask(n), return_counts=True)
            lower.append((below, continued.astype(np.float64)))
        raw.append(lower)
    raw.reverse()

    seen = np.unique(np.concatenate([keys for keys, _ in raw[0]]))
    model.floor = np.full(width, -np.log(len(seen) + 1))
    below_keys, below = np.empty(0, np.uint64), np.empty((0, width))
    for n in range(1, ORDER + 1):
        union = np.unique(np.concatenate([keys for keys, _ in raw[n - 1]]))
        contexts, context_of = np.unique(union >> np.uint64(16), return_inverse=True)
        if n == 1:
            lower = np.tile(np.exp(model.floor), (len(union), 1))
        else:
            lower = below[np.searchsorted(below_keys, union & _mask(n - 1))]
        value = np.empty((len(union), width))
        weight = np.ones((len(contexts), width))
        for k, (keys, count) in enumerate(raw[n - 1]):
            once, twice = (count == 1).sum(), (count == 2).sum()
            discount = min(max(once / max(once + 2 * twice, 1), 0.1), 0.95)
            held, owner = np.unique(keys >> np.uint64(16), return_inverse=True)
            total, kinds = np.bincount(owner, count), np.bincount(owner)
            weight[np.searchsorted(contexts, held), k] = discount * kinds / total
            value[:, k] = weight[context_of, k] * lower[:, k]
            value[np.searchsorted(union, keys), k] += (count - discount) / total[owner]
        below_keys, below = union, value
        for store, keys, values in ((model.grams, union, value), (model.backs, contexts, weight)):
            hashes = mix(keys)
            order = np.argsort(hashes)
            store.append((hashes[order], np.log(values[order])))
    return model


def log_probabilities(model: Model, keys: np.ndarray, n: int = ORDER) -> np.ndarray:
    """A row of log probabilities per key: the last of its ``n`` symbols after the others."""
    if n == 0:
        return np.tile(model.floor, (len(keys), 1))
    hashes, values = model.grams[n - 1]
    at, found = _find(hashes, mix(keys & _mask(n)))
    result = values[at] if len(values) else np.zeros((len(keys), len(model.languages)))
    missing = np.flatnonzero(~found)
    if len(missing):
        rest = keys[missing]
        hashes, weights = model.backs[n - 1]
        at, found = _find(hashes, mix((rest & _mask(n)) >> np.uint64(16)))
        result[missing] = log_probabilities(model, rest, n - 1) + weights[at] * found[:, None]
    return result


def cross_entropies(model: Model, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Per text: scored characters, and nats per character under each language."""
    keys, owner = symbols(texts)
    count = np.bincount(owner, minlength=len(texts))
    total = np.zeros((len(texts), len(model.languages)))
    if len(keys):
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        total[owner[first]] = -np.add.reduceat(log_probabilities(model, keys), first, axis=0)
    return count, total / np.maximum(count, 1)[:, None]


def _in_blocks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    first = size = 0
    for k, text in enumerate(texts):
        size += len(text or "")
        if size >= BLOCK_CHARS:
            yield first, k + 1
            first, size = k + 1, 0
    if first < len(texts):
        yield first, len(texts)


def _posterior(model: Model, count: np.ndarray, entropy: np.ndarray) -> np.ndarray:
    scaled = -model.sharpness * np.sqrt(count)[:, None] * entropy
    scaled -= scaled.max(axis=1, keepdims=True)
    return np.exp(scaled) / np.exp(scaled).sum(axis=1, keepdims=True)


def _deviation(usual: np.ndarray, best: np.ndarray, count: np.ndarray, entropy: np.ndarray):
    mean, fixed, per_character, _ = usual[:, best]
    return (entropy - mean) / np.sqrt(fixed + per_character / np.maximum(count, 1))


def calibrate(model: Model, lang: list[str], count: np.ndarray, entropy: np.ndarray) -> None:
    """Set the posterior's factor and the rejection's cutoffs from texts of known language."""
    width = len(model.languages)
    model.usual = np.tile(np.array([[0.0], [1.0], [1.0], [np.inf]]), (1, width))
    truth = np.array([model.languages.index(x) for x in lang], int)
    if not len(truth):
        return
    losses = []
    for model.sharpness in (grid := np.geomspace(0.1, 20, 30)):
        likely = _posterior(model, count, entropy)[np.arange(len(truth)), truth]
        losses.append(-np.log(np.maximum(likely, 1e-12)).mean())
    model.sharpness = float(grid[int(np.argmin(losses))])
    own = entropy[np.arange(len(truth)), truth]
    for k in range(width):
        of = truth == k
        if of.sum() < FEW:  # then the languages together say what is usual
            of[:] = True
        if of.sum() < FEW:
            continue
        n, nats = np.maximum(count[of], 1), own[of]
        model.usual[0, k] = mean = np.average(nats, weights=n)
        square = (nats - mean) ** 2
        model.usual[1, k] = max(np.median(square[n >= np.median(n)]) * 2, 1e-4)
        model.usual[2, k] = max(np.average(square * n), 1e-2)
        z = _deviation(model.usual, np.full(of.sum(), k), count[of], nats)
        model.usual[3, k] = 1.5 * max(np.quantile(z, 0.999), 2.0)


def _learning(docs: DataFrame, held: Column, columns: tuple[str, str, str], bound: int, chars: int):
    """The learning texts with a calibration flag, at most about ``bound`` per language, and of
    about ``chars`` characters."""
    identifier, text, lang = (docs[c] for c in columns)
    rows = docs.where(~F.coalesce(held, F.lit(True)) & lang.isNotNull() & text.isNotNull())
    sizes = rows.groupBy(lang.alias("lang")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length(text)).alias("chars")
    )
    shares = {r.lang: min(bound / r.n, chars / max(r.chars, 1)) for r in sizes.collect()}
    if not shares:
        return None
    share = F.create_map(*(F.lit(x) for pair in shares.items() for x in pair))
    draw = F.pmod(F.xxhash64(identifier, F.lit(7)), F.lit(1_000_000)) / F.lit(1_000_000.0)
    return rows.where(draw < share[lang]).select(
        lang.alias("lang"),
        text.alias("text"),
        (F.pmod(F.xxhash64(identifier, F.lit(11)), F.lit(10)) == 0).alias("calibration"),
    )


def fit(
    docs: DataFrame,
    held_out: Column,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    max_texts: int = 20_000,
    max_chars: int = 200_000_000,
) -> Model | None:
    """Models of all languages in ``lang_column`` where ``held_out`` is false, from about
    ``max_texts`` texts and ``max_chars`` characters of each: what the driver gets does not grow
    beyond that. Every n-gram of these texts is counted and kept."""
    rows = _learning(docs, held_out, (id_column, text_column, lang_column), max_texts, max_chars)
    if rows is None:
        return None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            texts = np.array(batch.column(1).to_pylist(), object)
            for lang in np.unique(langs.astype(str)):
                own = list(texts[langs == lang])
                for first, end in _in_blocks(own):
                    keys, n = np.unique(symbols(own[first:end])[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n)],
                        ["lang", "key", "n"],
                    )

    counted = (
        rows.where("not calibration")
        .select("lang", "text")
        .mapInArrow(count, "lang string, key long, n long")
        .groupBy("lang", "key")
        .agg(F.sum("n").alias("n"))
    )
    counts = counted.toPandas()
    if not len(counts):
        return None
    model = build(counts)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for first, end in _in_blocks(texts):
                n, entropy = cross_entropies(shared.value, texts[first:end])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[first:end], pa.array(n), pa.array(list(entropy))],
                    ["lang", "n", "entropy"],
                )

    known = rows.where(F.col("calibration") & F.col("lang").isin(model.languages))
    sample = (
        known.select("lang", "text")
        .mapInArrow(measure, "lang string, n long, entropy array<double>")
        .where("n > 0")
        .toPandas()
        .sort_values(["lang", "n"])
    )
    width = len(model.languages)
    entropy = np.array(sample["entropy"].tolist(), float).reshape(-1, width)
    calibrate(model, list(sample["lang"]), sample["n"].to_numpy(), entropy)
    return model


def identify(
    docs: DataFrame,
    model: Model | None,
    *,
    text_column: str = "text",
    columns: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``columns`` of each row with ``lang_pred``, ``score`` (posterior) and ``rejected``;
    those names in ``columns`` are left out."""
    results = ("lang_pred", "score", "rejected")
    carried = [c for c in columns if c not in results]
    text = docs[text_column].alias(free("_text", carried))
    chosen = docs.select(text, *(docs[c] for c in carried))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for first, end in _in_blocks(texts):
                own = [c[first:end] for c in batch.columns[1:]]
                found = [pa.array(x) for x in decide(shared.value, texts[first:end])]
                yield pa.RecordBatch.from_arrays([*own, *found], [*carried, *results])

    schema = StructType(chosen.schema.fields[1:])
    for name, kind in zip(results, (StringType(), DoubleType(), BooleanType()), strict=True):
        schema = schema.add(name, kind)
    return chosen.mapInArrow(work, schema)


def decide(model: Model | None, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, posterior and rejection of each text."""
    if model is None:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
    count, entropy = cross_entropies(model, texts)
    best = entropy.argmin(axis=1)
    rows = np.arange(len(texts))
    score = np.where(count > 0, _posterior(model, count, entropy)[rows, best], 0.0)
    own = entropy[rows, best]
    far = _deviation(model.usual, best, count, own) > model.usual[3, best]
    far &= own - model.usual[0, best] > LEAST_EXCESS
    lang = [model.languages[k] if n else UNKNOWN for k, n in zip(best, count, strict=True)]
    return lang, score, far | (count == 0)


def every_fifth(identifier: Column) -> Column:
    """The fold that learning leaves out: CRC-32 of the id's text divisible by five."""
    return F.crc32(identifier.cast("string").cast("binary")) % 5 == 0
