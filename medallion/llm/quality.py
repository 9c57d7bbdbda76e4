"""Quality classifier on random-indexing word vectors.

Method: every token has a sparse ternary index vector given by its hash. A token's word vector
is its index vector plus the normalised sum of the index vectors around it in the learning
texts. A document is the mean of its word vectors, beside the means of the index vectors of
its tokens' shapes (case, length, kind of character), of how tokens join, and of how far back
the same token stood last. A two-layer network in numpy maps that to a logit; a temperature
found on texts kept out of its training makes the probabilities calibrated.

Fitting uses at most about ``max_texts`` labelled rows, chosen by a hash of the id; their texts
reach the executors only, the driver gets word vectors and document vectors. Every text is
scored whole, in one pass without a shuffle.

Defined cases: a null or empty text has a zero vector and gets a score like any other; an id
with several labels counts with the largest; null labels are ignored; without labels every
score is 0.5; other columns are ignored; repeated rows are separate texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, StructType

from medallion.llm.arrays import blocks, hash_runs, mix, per_text, utf8
from medallion.llm.store import broadcast_within, stored

WORDS = 1 << 15  # hashed vocabulary of the word vectors
SHAPES, JOINS, DISTANCES = 256, 32, 32
WIDTH = 64
NONZERO = 6
HIDDEN = 32
PARTS = 8  # partitions of the learning texts, each with word vectors of its own to add up
BLOCK_BYTES = 1 << 18
_KIND = np.full(256, 3, np.uint8)  # 0 space, 1 letter, 2 digit, 3 other
_KIND[[32, 9, 10, 11, 12, 13]] = 0
_KIND[48:58] = 2
_KIND[65:91] = _KIND[97:123] = 1
_KIND[128:] = 1
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def index_vectors(count: int, seed: int) -> np.ndarray:
    """Sparse rows of -1, 0 and 1, given by the row number alone."""
    vectors = np.zeros((count, WIDTH), np.float32)
    rows = np.arange(count, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(NONZERO):
            h = mix(rows * np.uint64(64) + np.uint64(k) + mix(np.array([seed])))
            vectors[rows.astype(np.int64), (h % np.uint64(WIDTH)).astype(np.int64)] += np.where(
                h >> np.uint64(63), 1, -1
            )
    return vectors


_SHAPE_VECTORS = index_vectors(SHAPES, 1)
_JOIN_VECTORS = index_vectors(JOINS, 2)
_DISTANCE_VECTORS = index_vectors(DISTANCES, 3)


@dataclass
class Tokens:
    at: np.ndarray  # bounds of each text's tokens
    word: np.ndarray
    shape: np.ndarray
    join: np.ndarray
    distance: np.ndarray


def tokens(data: np.ndarray, bounds: np.ndarray) -> Tokens:
    """Runs of letters, of digits and of other characters, with their features."""
    kind = _KIND[data]
    change = np.empty(len(data), bool)
    change[:1] = True
    change[1:] = kind[1:] != kind[:-1]
    change[bounds[:-1][bounds[:-1] < len(data)]] = True
    edges = np.flatnonzero(change)
    ends = np.append(edges[1:], len(data))
    solid = kind[edges] > 0
    starts, ends = edges[solid], ends[solid]
    at = per_text(starts, bounds)
    if not len(starts):
        none = np.empty(0, np.int64)
        return Tokens(at, none, none, none, none)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(at))
    hashes = hash_runs(_FOLD[data], starts, ends)
    length = ends - starts
    own = kind[starts]
    upper = np.append(0, np.cumsum((data >= 65) & (data <= 90)))
    capitals = upper[ends] - upper[starts]
    first = (data[starts] >= 65) & (data[starts] <= 90)
    case = np.where(capitals == 0, 0, np.where(capitals == length, 2, np.where(first, 1, 3)))
    size = np.minimum(np.log2(length).astype(np.int64), 5)
    letter = 4 * size + case
    other = 64 + 6 * (data[starts].astype(np.int64) % 24) + np.minimum(length, 6) - 1
    shape = np.where(own == 1, letter, np.where(own == 2, 32 + size, other))
    glued = np.zeros(len(starts), np.int64)
    glued[1:] = (starts[1:] == ends[:-1]) & (owner[1:] == owner[:-1])
    before = np.zeros(len(starts), np.int64)
    before[1:] = np.where(owner[1:] == owner[:-1], own[:-1], 0)
    with np.errstate(over="ignore"):
        named = mix(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(named, kind="stable")
    same = named[order[1:]] == named[order[:-1]]
    back = np.zeros(len(starts), np.int64)
    back[order[1:][same]] = (order[1:] - order[:-1])[same]
    distance = np.where(back > 0, np.minimum(np.log2(np.maximum(back, 1)).astype(np.int64), 11) + 1, 0)
    # joined with the kind of token, as repeated marks say less than repeated words
    distance += 13 * (own == 3)
    word = (hashes % np.uint64(WORDS)).astype(np.int64)
    return Tokens(at, word, shape, 8 * glued + 4 * (own > 1) + before, distance)


def _token_blocks(column: pa.Array) -> Iterator[Tokens]:
    data, offsets = utf8(column)
    for _, _, part, bounds in blocks(data, offsets, BLOCK_BYTES):
        yield tokens(part, bounds)


def contexts(column: pa.Array, index: np.ndarray, total: np.ndarray) -> None:
    """Add to ``total`` the index vectors of the two tokens on each side of every token."""
    for t in _token_blocks(column):
        for k in range(len(t.at) - 1):
            word = t.word[t.at[k] : t.at[k + 1]]
            if len(word) < 2:
                continue
            around = np.zeros((len(word), WIDTH), np.float32)
            for step in (1, 2):
                around[step:] += index[word[:-step]]
                around[:-step] += index[word[step:]]
            order = np.argsort(word, kind="stable")
            first = np.flatnonzero(np.diff(word[order], prepend=-1))
            total[word[order][first]] += np.add.reduceat(around[order], first, axis=0)


def _mean_counts(ids: np.ndarray, owner: np.ndarray, rows: int, kinds: int, count: np.ndarray) -> np.ndarray:
    table = np.bincount(owner * kinds + ids, minlength=rows * kinds).reshape(rows, kinds)
    return table / count


def vectors(column: pa.Array, words: np.ndarray) -> Iterator[np.ndarray]:
    """A row for each text of each block."""
    for t in _token_blocks(column):
        rows = len(t.at) - 1
        sizes = np.diff(t.at)
        owner = np.repeat(np.arange(rows), sizes)
        count = np.maximum(sizes, 1)[:, None]
        pooled = np.zeros((rows, WIDTH), np.float32)
        full = np.flatnonzero(sizes)
        if len(full):
            pooled[full] = np.add.reduceat(words[t.word], t.at[full], axis=0)
        yield np.hstack(
            [
                pooled / count,
                _mean_counts(t.shape, owner, rows, SHAPES, count) @ _SHAPE_VECTORS,
                _mean_counts(t.join, owner, rows, JOINS, count) @ _JOIN_VECTORS,
                _mean_counts(t.distance, owner, rows, DISTANCES, count) @ _DISTANCE_VECTORS,
                np.log1p(sizes)[:, None],
            ]
        ).astype(np.float32)


@dataclass
class Network:
    """Standardisation, two layers and a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    bias: np.ndarray
    second: np.ndarray
    offset: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh(((x - self.mean) / self.scale) @ self.first + self.bias)
        return hidden @ self.second + self.offset

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def train(x: np.ndarray, y: np.ndarray, seed: int = 1, epochs: int = 60, batch: int = 128) -> Network:
    """Fit by Adam on the cross-entropy with weight decay."""
    x = x.astype(np.float64)
    random = np.random.default_rng(seed)
    net = Network(
        x.mean(0),
        x.std(0) + 1e-3,
        random.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        random.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
        0.0,
    )
    z = (x - net.mean) / net.scale
    values = [net.first, net.bias, net.second, np.zeros(1)]
    moments = [(np.zeros_like(v), np.zeros_like(v)) for v in values]
    step = 0
    for epoch in range(epochs):
        rate = 3e-3 * (1 - epoch / epochs) + 1e-4
        order = random.permutation(len(z))
        for k in range(0, len(z), batch):
            rows = order[k : k + batch]
            hidden = np.tanh(z[rows] @ values[0] + values[1])
            error = 1 / (1 + np.exp(-np.clip(hidden @ values[2] + values[3], -40, 40))) - y[rows]
            error /= len(rows)
            back = np.outer(error, values[2]) * (1 - hidden**2)
            slopes = [
                z[rows].T @ back + 1e-4 * values[0],
                back.sum(0),
                hidden.T @ error + 1e-4 * values[2],
                np.array([error.sum()]),
            ]
            step += 1
            for v, slope, (m, s) in zip(values, slopes, moments, strict=True):
                m += 0.1 * (slope - m)
                s += 0.001 * (slope**2 - s)
                v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    net.offset = float(values[3][0])
    return net


def temper(net: Network, x: np.ndarray, y: np.ndarray) -> None:
    """Set the temperature with the least cross-entropy on ``x``."""
    if not len(y):
        return
    logits, best = net.logits(x), np.inf
    for temperature in np.geomspace(0.25, 8, 60):
        z = logits / temperature
        loss = np.mean(np.logaddexp(0, z) - y * z)
        if loss < best:
            best, net.temperature = loss, float(temperature)


@dataclass
class Model:
    words: np.ndarray
    net: Network


def fit(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    max_texts: int = 12_000,
) -> Model | None:
    """Learn from labelled rows where ``held_out`` (of the labels' id) is false, at most
    ``max_texts`` different ones, chosen by hash."""
    rows = labels.where(~F.coalesce(held_out, F.lit(True)) & labels[label_column].isNotNull())
    rows = rows.groupBy(labels[id_column].alias("id")).agg(F.max(label_column).cast("int").alias("label"))
    named = docs.select(
        docs[id_column].alias("id"), docs[text_column].alias("text"), F.xxhash64(docs[text_column]).alias("h")
    )
    # labelled texts by id and hash, each once: an id may stand on any number of rows
    draw = F.xxhash64("id", "h", F.lit(3))
    keys = named.select("id", "h").join(broadcast_within(stored(rows, "labels")), "id")
    keys = stored(keys.groupBy("id", "h").agg(F.max("label").alias("label")), "labelled")
    least = keys.select(draw.alias("draw")).orderBy("draw").limit(max_texts).agg(F.max("draw")).first()[0]
    if least is None:
        return None
    chosen = keys.where(draw <= least)
    tempering = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(5)) == 0
    # ``max_texts`` bounds what is chosen
    sample = named.join(F.broadcast(chosen), ["id", "h"]).dropDuplicates(["id", "h"])
    sample = sample.select("id", "label", tempering.alias("tempering"), "text", "h")
    sample = sample.repartition(PARTS, "id", "h").persist()
    try:
        return _fit(sample)
    finally:
        sample.unpersist()


def _fit(sample: DataFrame) -> Model | None:
    spark = sample.sparkSession

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, total = index_vectors(WORDS, 0), np.zeros((WORDS, WIDTH), np.float32)
        for batch in batches:
            contexts(batch.column(0), index, total)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

    total = np.zeros((WORDS, WIDTH))
    for row in sample.select("text").mapInArrow(around, "total binary").toLocalIterator():
        total += np.frombuffer(row["total"], np.float32).reshape(WORDS, WIDTH)
    length = np.linalg.norm(total, axis=1, keepdims=True)
    words = (index_vectors(WORDS, 0) + np.sqrt(NONZERO) * total / np.maximum(length, 1)).astype(np.float32)
    shared = spark.sparkContext.broadcast(words)

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [v for part in vectors(batch.column(3), shared.value) for v in part]
            pooled = pa.array(found, pa.list_(pa.float32()))
            columns = [*batch.columns[:3], batch.column(4), pooled]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "tempering", "h", "vector"])

    schema = StructType([sample.schema[c] for c in ("id", "label", "tempering", "h")])
    schema = schema.add("vector", ArrayType(FloatType()))
    known = sample.mapInArrow(pool, schema).toArrow().sort_by([("id", "ascending"), ("h", "ascending")])
    if not len(known):
        return None
    x = known["vector"].combine_chunks().flatten().to_numpy().reshape(len(known), -1)
    y = known["label"].to_numpy().astype(float)
    apart = known["tempering"].to_numpy().copy()
    if apart.all():
        apart[:] = False
    net = train(x[~apart], y[~apart])
    temper(net, x[apart], y[apart])
    return Model(words, net)


def score(
    docs: DataFrame, model: Model | None, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The id of each row and ``score``, the probability of label 1."""
    chosen = docs.select(docs[id_column], docs[text_column].alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = shared.value
            if own is None:
                found = np.full(batch.num_rows, 0.5)
            else:
                parts = [own.net.probabilities(v) for v in vectors(batch.column(1), own.words)]
                found = np.concatenate([np.empty(0), *parts])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names)

    names = [id_column, "score"]
    return chosen.mapInArrow(work, StructType(chosen.schema.fields[:1]).add("score", DoubleType()))


def third_of_four(identifier: Column) -> Column:
    """The fold that learning leaves out: CRC-32 of the id's text is 2 modulo 4."""
    return F.crc32(identifier.cast("string").cast("binary")) % 4 == 2
