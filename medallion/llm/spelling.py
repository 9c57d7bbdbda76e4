"""Spelling variants: words one edit apart, found over a reduced alphabet.

Method: each letter is hashed to one of ``SYMBOLS`` symbols. Two words that differ by one edit
have reduced words that are equal or differ by one edit, so the full one-edit neighbourhood of
every reduced word (itself, all deletions, replacements and insertions) is generated and joined
with the reduced vocabulary. What meets is verified on the original strings inside the join, so
no table has a row for words that are not near.

Neighbours are hashes of reduced strings, made from hashes of prefixes and suffixes in a slice of
positions at a time, and long words travel by a 64-bit hash, so a word of a million letters costs
its length and not its square. Of edits that lead to the same string only the first is made: a
deletion at the start of a run of equal symbols, and an insertion in front of one. So a pair
meets once.

Words are counted in each task before the one shuffle that sums them. A form has at least
``RATIO`` times the occurrences of its word, so chains have no circle and no more than
log(largest count) steps, which pointer doubling follows in a fixed number of joins.

Defined cases: a null text has no words; a null id is empty in front of the colon of the hash;
rows that share an id are separate texts; other columns are ignored; an empty table, or one
without a word that often, gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.llm.arrays import mix, random_words
from medallion.llm.store import parts, stored

LENGTH, OCCURRENCES = 6, 5
RATIO = 5
SYMBOLS = 8
SPOILT = 199  # a run whose hash this divides loses a letter
FLUSH_WORDS, FLUSH_LETTERS = 200_000, 1 << 23  # what a task holds before it hands counts on
SLICE = 1 << 18  # neighbours made together
NEIGHBOURING = 20_000  # words whose neighbours one task makes
SHORT = 64  # letters of a word that goes along with its neighbours
_RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % LENGTH)
_LOWER = {k: k + 32 for k in range(65, 91)}
_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SYMBOL = random_words(0x100, 31)


def _lowered(run: str) -> str:
    return run.lower() if run.isascii() else run.translate(_LOWER)


def counted(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``word`` and ``n`` of every word of enough letters and occurrences."""
    chosen = docs.select(
        F.coalesce(docs[id_column].cast("string"), F.lit("")).alias("id"), docs[text_column].alias("text")
    ).where("text is not null")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        letters = 0
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                seed = crc32(f"{name}:".encode())
                for run, n in Counter(_RUN.findall(text.as_py())).items():
                    word = _lowered(run)
                    h = crc32(word.encode(), seed)
                    if h % SPOILT == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < LENGTH:
                            continue
                    if word not in total:
                        letters += len(word)
                    total[word] += n
                if len(total) > FLUSH_WORDS or letters > FLUSH_LETTERS:
                    yield _counts(total)
                    total, letters = Counter(), 0
        yield _counts(total)

    parts = chosen.mapInArrow(work, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= OCCURRENCES)


def _counts(total: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"]
    )


def reduced(words: list[str], symbols: int) -> np.ndarray:
    """The symbols, from 1, of words of equal length, a row for each."""
    points = np.array([[ord(c) for c in w] for w in words], np.int64)
    return _SYMBOL[points & 0xFF] % np.uint64(8191) % np.uint64(symbols) + np.uint64(1)


def _powers(count: int) -> np.ndarray:
    powers = np.ones(count, np.uint64)
    powers[1:] = np.cumprod(np.full(count - 1, _BASE, np.uint64))
    return powers


def own_keys(rows: np.ndarray) -> np.ndarray:
    """The hash of each reduced word."""
    with np.errstate(over="ignore"):
        return mix((rows * _powers(rows.shape[1])).sum(axis=1))


def neighbour_keys(rows: np.ndarray, symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row and hash of every string within one edit of the reduced words, each once."""
    count, length = rows.shape
    with np.errstate(over="ignore"):
        powers = _powers(length + 1)
        before = np.zeros((count, length + 1), np.uint64)
        np.cumsum(rows * powers[:length], axis=1, out=before[:, 1:])
        whole = before[:, -1:]
        each = np.arange(count)
        yield each, mix(whole[:, 0])
        step = max(1, SLICE // count)
        for start in range(0, length + 1, step):
            at = slice(start, min(start + step, length + 1))
            here = slice(start, min(start + step, length))
            symbol = rows[:, here]
            left = np.zeros((count, at.stop - at.start), np.uint64)  # the symbol in front
            left[:, 1 if start == 0 else 0 :] = rows[:, max(start, 1) - 1 : at.stop - 1]
            if symbol.shape[1]:
                first = symbol != left[:, : symbol.shape[1]]
                after = whole - before[:, here.start + 1 : here.stop + 1]
                yield np.nonzero(first)[0], mix((before[:, here] + after * _INVERSE)[first])
            for c in range(1, symbols + 1):
                new = np.uint64(c)
                if symbol.shape[1]:
                    other = symbol != new
                    yield np.nonzero(other)[0], mix((whole + (new - symbol) * powers[here])[other])
                fresh = left != new
                made = before[:, at] + new * powers[at] + (whole - before[:, at]) * _BASE
                yield np.nonzero(fresh)[0], mix(made[fresh])


def _keyed(words: DataFrame, symbols: int, full: bool) -> DataFrame:
    """``key`` of each word of an (id, word, n) table, or of its whole neighbourhood, with the
    word itself in ``short`` if it is one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            lengths = np.array([len(t) for t in texts])
            short = pa.array([t if len(t) <= SHORT else None for t in texts], pa.string())
            carried = pa.RecordBatch.from_arrays([batch.column(0), short, batch.column(2)], ["id", "short", "n"])
            for length in np.unique(lengths):
                chosen = np.flatnonzero(lengths == length)
                # as many words as fit a slice, so that long ones do not add up
                step = max(1, SLICE // int(length))
                for k in range(0, len(chosen), step):
                    rows = chosen[k : k + step]
                    symbols_ = reduced([texts[r] for r in rows], symbols)
                    if full:
                        parts = neighbour_keys(symbols_, symbols)
                    else:
                        parts = iter([(np.arange(len(rows)), own_keys(symbols_))])
                    for of, keys in parts:
                        columns = carried.take(pa.array(rows[of])).columns
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys.view(np.int64)), *columns], ["key", "id", "short", "n"]
                        )

    return words.select("id", "word", "n").mapInArrow(work, "key long, id long, short string, n long")


def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """``id``, ``near`` and ``near_n`` of all words (id, word, n) that differ by one edit. Short
    words are verified where their keys meet; long ones, which hardly ever meet by chance, after
    their letters have been looked up."""
    # few files hold a vocabulary, and each word has many neighbours
    spread = words.repartition(parts(words, NEIGHBOURING), "id")
    around = _keyed(spread, symbols, full=True).select("key", "id", "short")
    vocabulary = _keyed(words, symbols, full=False).select(
        "key", F.col("id").alias("near_id"), F.col("short").alias("near"), F.col("n").alias("near_n")
    )
    one_edit = F.coalesce(F.levenshtein("short", "near", 1) == 1, F.lit(True))
    met = around.join(vocabulary, (around["key"] == vocabulary["key"]) & one_edit)
    met = stored(met.where("id <> near_id").select("id", "short", "near_id", "near", "near_n"), "met")
    both = F.col("short").isNotNull() & F.col("near").isNotNull()
    left = words.select("id", F.col("word").alias("a"))
    right = words.select(F.col("id").alias("near_id"), F.col("word").alias("b"))
    long = met.where(~both).select("id", "near_id", "near_n").join(left, "id").join(right, "near_id")
    long = long.where(F.levenshtein("a", "b", 1) == 1).select("id", F.col("b").alias("near"), "near_n")
    return met.where(both).select("id", "near", "near_n").union(long)


def roots(forms: DataFrame, largest: int) -> DataFrame:
    """``word`` and ``root`` of words that have a ``form``, for counts up to ``largest``."""
    steps = math.log(max(largest, OCCURRENCES) / OCCURRENCES) / math.log(RATIO) + 1e-9
    found = forms.select("word", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(max(steps, 1))))):
        onward = found.select(F.col("word").alias("at"), F.col("root").alias("next"))
        found = found.join(onward, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("next", "root").alias("root")
        )
        found = stored(found, "roots")
    return found


def variants(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", symbols: int = SYMBOLS
) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n`` and ``root`` of every word."""
    words = counted(docs, id_column, text_column).select(F.xxhash64("word").alias("id"), "word", "n")
    words = stored(words, "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = near_words(words, symbols).groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    formed = words.join(near, "id", "left")
    fits = -F.col("best.less") >= RATIO * F.col("n")
    formed = formed.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("best.near")).alias("form"),
        F.when(fits, -F.col("best.less")).alias("form_n"),
    )
    formed = stored(formed, "formed")
    largest = formed.agg(F.max("n")).first()[0] or 0
    found = roots(formed.where("form is not null"), largest)
    return formed.join(found, "word", "left").select(
        "word", F.coalesce("root", "word").alias("root"), "form", "n", "n_near", "form_n"
    )
