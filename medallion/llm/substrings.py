"""Repeated passages by content-defined chunks.

Method: a gear hash rolls over the bytes of a text; where its leading bits are zero a chunk
ends. The hash sees the last 16 bytes only, so after an insertion the chunks fall back into
step. What is looked up by digest is a window: the fewest consecutive chunks from a chunk on,
or up to a chunk, that hold enough words. A window that also stands in a document of a smaller
id is a repeat. One document has the whole window, so chunks that are common by chance, and
short lines, do not add up to one; and a run of chunks that any earlier document has is made
of its windows, whichever documents have parts of it too.

Chunks average 24 bytes, so a passage of 50 words loses about 40 bytes at its ends. The texts
are chunked twice instead of stored. Digests are reduced to their least and largest document
before a shuffle; those in several documents are a stored table, broadcast if counted to be
few, else joined, where adaptive execution splits a digest that a third of the documents have.

Defined cases: null or empty texts have no chunks; rows with a null id neither repeat nor are
repeated; rows that share an id do not repeat each other, nor does a text repeat itself; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from medallion.llm.arrays import blocks, hash_runs, mix, random_words, utf8
from medallion.llm.store import free, stored

LEAST, MOST = 8, 64  # bytes of a chunk
SPAN, ZERO_BITS = 16, 4  # bytes the hash sees; a chunk ends at one byte in 2^ZERO_BITS
BROADCAST_DIGESTS = 500_000
_GEAR = (random_words(256, 21) >> np.uint64(48)).astype(np.uint16)
_FACTOR = int(random_words(1, 23)[0])
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def _gear(data: np.ndarray) -> np.ndarray:
    """At each byte, the sum of the gear values of the last 16 bytes, shifted by their age."""
    h = _GEAR[data]
    age = 1
    while age < SPAN:
        longer = h.copy()
        longer[age:] += h[:-age] << np.uint16(age)
        h, age = longer, 2 * age
    return h


def _powers(base: int, count: int) -> np.ndarray:
    """``base`` to the powers from 0 to ``count`` - 1, modulo 2^64."""
    powers = np.full(count, base, np.uint64)
    powers[:1] = 1
    return np.cumprod(powers, dtype=np.uint64)


def chunk_ends(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Ends of the chunks of each text, in order; a chunk starts where the last one ended."""
    if not len(data):
        return np.empty(0, np.int64)
    # a chunk may end before a byte that begins a character, and not where the hash still
    # sees the text before
    open_ = np.empty(len(data), bool)
    open_[-1] = True
    open_[:-1] = (data[1:] & 0xC0) != 0x80
    hashes = _gear(data)
    proposed = np.flatnonzero(open_ & ((hashes >> np.uint16(16 - ZERO_BITS)) == 0)) + 1
    hashes[~open_] = 0xFFFF
    ends: list[int] = []

    def split(last: int, end: int) -> int:
        """Chunks without a proposed end, as in a run of one word: they end at the last least
        hash, which is the same place of the period in every text."""
        while end - last > MOST:
            window = hashes[last + LEAST : last + MOST][::-1]
            last += MOST - int(window.argmin())
            ends.append(last)
        return last

    cuts = np.searchsorted(proposed, bounds, "right").tolist()
    limits = bounds.tolist()
    every = proposed.tolist()
    for k in range(len(limits) - 1):
        last, stop = limits[k], limits[k + 1]
        settled = last + SPAN
        for end in every[cuts[k] : cuts[k + 1]]:
            if end < settled or end - last < LEAST:
                continue
            if end - last > MOST:
                last = split(last, end)
            if end > last:
                ends.append(end)
                last = end
        last = split(last, stop)
        if last < stop:
            ends.append(stop)
    return np.array(ends, np.int64)


def _windows(sums: np.ndarray, least: np.ndarray, bounds: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """First chunks and ends (chunk numbers) of the windows. ``sums``: words begun before each
    chunk and at the end; ``least``: the same before the word in which a chunk starts;
    ``bounds``: of the texts, in chunks."""
    every = np.arange(len(least))
    text = np.searchsorted(bounds, every, "right") - 1
    ends = np.searchsorted(sums, least + min_words, "left")
    inside = ends <= bounds[text + 1]
    forward = every[inside], ends[inside]
    starts = np.searchsorted(least, sums[1:] - min_words, "right") - 1
    # a window up to a chunk that is also the one from its first chunk on is there already
    inside = starts >= bounds[text]
    inside[inside] = ends[starts[inside]] != every[inside] + 1
    return np.append(forward[0], starts[inside]), np.append(forward[1], every[inside] + 1)


def windows(docs: DataFrame, id_column: str, text_column: str, min_words: int) -> DataFrame:
    """``id``, ``digest``, ``at`` (start * 2^32 + bytes) and ``words`` (words of the text before
    it * 2^32 + words) of each window. A word that begins before a window counts in it."""
    chosen = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))
    chosen = chosen.where("id is not null and text <> ''")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for first, _, part, bounds in blocks(data, offsets):
                ends = chunk_ends(part, bounds)
                starts = np.append(0, ends[:-1])[: len(ends)]
                letters = ~_SPACE[part]
                begins = letters.copy()
                begins[1:] &= _SPACE[part[:-1]]
                begins[bounds[:-1][bounds[:-1] < len(part)]] |= ~_SPACE[part[bounds[:-1][bounds[:-1] < len(part)]]]
                sums = np.append(0, np.cumsum(begins))
                least = sums[starts] - (letters & ~begins)[starts]
                sums = sums[np.append(starts, len(part))]
                of = np.searchsorted(starts, bounds, "left")
                x, y = _windows(sums, least, of, min_words)
                with np.errstate(over="ignore"):
                    # sums of the chunks' hashes times powers, made independent of the place
                    values = hash_runs(part, starts, ends) * _powers(_FACTOR, len(ends))
                    totals = np.append(np.uint64(0), np.cumsum(values))
                    digests = (totals[y] - totals[x]) * _powers(_INVERSE, len(ends) + 1)[x]
                    digests = mix(digests + (y - x).astype(np.uint64))
                owner = np.searchsorted(bounds, starts[x], "right") - 1
                before = sums[of[:-1]][owner] if len(x) else x
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(first + owner)),
                        pa.array(digests.view(np.int64)),
                        pa.array((starts[x] - bounds[owner] << 32) + ends[y - 1] - starts[x]),
                        pa.array((least[x] - before << 32) + sums[y] - least[x]),
                    ],
                    ["id", "digest", "at", "words"],
                )

    schema = StructType([chosen.schema["id"]])
    for name in ("digest", "at", "words"):
        schema = schema.add(name, LongType())
    return chosen.mapInArrow(work, schema)


def repeated_passages(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", min_words: int = 20
) -> DataFrame:
    """(id, source id, ``start``, ``length``, ``n_words``): stretches of UTF-8 bytes of a text
    that an earlier document has, with at least ``min_words`` words in whole common chunks, the
    first and last perhaps in part. Stretches of different sources may overlap."""
    found = windows(docs, id_column, text_column, min_words)
    several = (
        found.groupBy("digest")
        .agg(F.min("id").alias("least"), F.max("id").alias("most"))
        .where("least < most")
        .select("digest", "least")
    )
    several = stored(several, "digests")
    if several.count() <= BROADCAST_DIGESTS:
        several = F.broadcast(several)

    def low(c: str) -> Column:
        return F.col(c).bitwiseAND((1 << 32) - 1)

    start, word = F.shiftright("at", 32), F.shiftright("words", 32)
    repeats = (
        found.join(several, "digest")
        .where("least < id")
        .select(
            "id",
            "least",
            start.alias("start"),
            (start + low("at")).alias("end"),
            word.alias("word"),
            (word + low("words")).alias("end_word"),
        )
    )
    in_text = Window.partitionBy("id", "least").orderBy("start", "end")
    before = F.max("end").over(in_text.rowsBetween(Window.unboundedPreceding, -1))
    passages = repeats.select("*", F.when(F.col("start") <= before, F.lit(0)).otherwise(F.lit(1)).alias("new")).select(
        "*", F.sum("new").over(in_text.rowsBetween(Window.unboundedPreceding, 0)).alias("passage")
    )
    return (
        passages.groupBy("id", "least", "passage")
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            (F.max("end_word") - F.min("word")).alias("n_words"),
        )
        .select(
            F.col("id").alias(id_column),
            F.col("least").alias(f"source_{id_column}"),
            "start",
            (F.col("end") - F.col("start")).alias("length"),
            "n_words",
        )
    )


def without_passages(
    docs: DataFrame, passages: DataFrame, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``docs`` with the passages cut out of their texts."""
    key, cut = free("_id", docs.columns), free("_cuts", docs.columns)
    cuts = passages.groupBy(F.col(id_column).alias(key)).agg(
        F.array_sort(F.collect_list(F.struct("start", "length"))).alias(cut)
    )
    at = docs.columns.index(text_column)
    joined = docs.join(cuts, docs[id_column] == cuts[key], "left")
    joined = joined.select(*(docs[c] for c in docs.columns), cut)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for k, spans in enumerate(batch.columns[-1].to_pylist()):
                if spans and texts[k]:
                    data, last, kept = texts[k].encode(), 0, []
                    for span in spans:
                        kept.append(data[last : span["start"]])
                        last = max(last, span["start"] + span["length"])
                    texts[k] = b"".join([*kept, data[last:]]).decode(errors="replace")
            columns = [*batch.columns[:-1]]
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, names)

    names = docs.columns
    return joined.mapInArrow(work, docs.schema)
