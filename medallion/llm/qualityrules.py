"""Quality rules with line frequency across documents.

Method: each document's lines are normalised (white space collapsed, A-Z lower-cased) and
hashed; for each host the documents that contain a line are counted; lines on more documents
than the host's limit are removed; a document that keeps too small a part of its words is
depleted and rejected. Before that stand the base rules on length and on repeated windows.

One pass over the texts writes the figures of the base rules and the hashes of the lines; the
counts are reduced inside each partition before their only shuffle, so a hot host or line is a
key of partial sums. A host has at most (distinct lines per document) / ``share`` lines above
its limit; they travel as one array per host, broadcast only if counted to be few.

Defined cases: a null or wordless text has no words, so it fails the base rules; a null host is
the empty host; repeated rows count as documents; blank lines are never counted; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from medallion.llm.arrays import blocks, hash_runs, per_text, runs, utf8, window_hashes
from medallion.llm.store import stored

WINDOW = 8
BROADCAST_LINES = 500_000
FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LEADING = np.ones(256, bool)  # bytes that begin a code point
_LEADING[0x80:0xC0] = False


def repeated_words(hashes: np.ndarray) -> int:
    """Words in windows whose hash occurs twice or more; ``hashes`` has one per window."""
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    if not same.any():
        return 0
    again = np.zeros(len(hashes), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    cover = np.zeros(len(hashes) + WINDOW, np.int64)
    places = np.flatnonzero(again)
    cover[places] += 1
    cover[places + WINDOW] -= 1
    return int((np.cumsum(cover)[:-1] > 0).sum())


def _lines(text: bytes) -> tuple[int, list[int], list[int]]:
    """Lines equal to an earlier one, and hash and words of each line that has a word."""
    seen: set[bytes] = set()
    repeats, hashes, words = 0, [], []
    for line in text.split(b"\n"):
        parts = line.split()
        if parts:
            repeats += line in seen
            seen.add(line)
            digest = hashlib.blake2b(b" ".join(parts).lower(), digest_size=8).digest()
            hashes.append(int.from_bytes(digest, "little", signed=True))
            words.append(len(parts))
    return repeats, hashes, words


def measured(column: pa.Array) -> list[pa.Array]:
    """``FIGURES`` and the lines' hashes and words, for each text."""
    rows: list[list] = [[] for _ in range(7)]
    data, offsets = utf8(column)
    for first, end, part, bounds in blocks(data, offsets):
        space = _SPACE[part]
        starts, ends = runs(~space, bounds)
        windows = window_hashes(hash_runs(part, starts, ends), WINDOW, 8)
        at = per_text(starts, bounds)
        for total, marked in ((rows[1], ~space & _LEADING[part]), (rows[2], _SYMBOL[part])):
            sums = np.append(0, np.cumsum(marked))
            total.extend(sums[bounds[1:]] - sums[bounds[:-1]])
        rows[0].extend(np.diff(at))
        for k in range(end - first):
            repeats, hashes, words = _lines(part[bounds[k] : bounds[k + 1]].tobytes())
            rows[3].append(repeats)
            rows[4].append(repeated_words(windows[at[k] : max(at[k + 1] - WINDOW + 1, at[k])]))
            rows[5].append(hashes)
            rows[6].append(words)
    return [pa.array(r, pa.int64()) for r in rows[:5]] + [pa.array(r, pa.list_(pa.int64())) for r in rows[5:]]


def base_failed(n_words, n_repeat_words):
    """Too short, or more than 30 % of the words in repeated windows."""
    return (n_words < 20) | (100 * n_repeat_words > 30 * n_words)


def apply_rules(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    host_column: str = "source",
    text_column: str = "text",
    min_documents: int = 20,
    share: float = 0.02,
    least_left: float = 0.3,
) -> DataFrame:
    """The id of each row with ``FIGURES``, ``base_failed``, ``n_removed`` (words in lines above
    the host's limit, the larger of ``min_documents`` and ``share`` of its documents) and
    ``kept``: base rules passed and at least ``least_left`` of the words left."""
    chosen = docs.select(
        docs[id_column].alias("id"),
        F.coalesce(docs[host_column].cast("string"), F.lit("")).alias("host"),
        docs[text_column].alias("text"),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(0), batch.column(1), *measured(batch.column(2))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "host", *FIGURES, "lines", "words"])

    schema = StructType([chosen.schema["id"]]).add("host", StringType())
    for name in FIGURES:
        schema = schema.add(name, LongType())
    schema = schema.add("lines", ArrayType(LongType())).add("words", ArrayType(LongType()))
    made = stored(chosen.mapInArrow(work, schema), "figures")

    documents = made.groupBy("host").agg(F.count(F.lit(1)).alias("documents"))
    frequent = (
        made.select("host", F.explode(F.array_distinct("lines")).alias("line"))
        .groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > min_documents)
        .join(documents, "host")
        .where(F.col("n") > share * F.col("documents"))
        .groupBy("host")
        .agg(F.collect_set("line").alias("frequent"))
    )
    frequent = stored(frequent, "frequent")
    if (frequent.agg(F.sum(F.size("frequent"))).first()[0] or 0) <= BROADCAST_LINES:
        frequent = F.broadcast(frequent)
    removed = F.aggregate(
        F.zip_with(
            "lines",
            "words",
            lambda line, n: F.when(F.array_contains("frequent", line), n).otherwise(F.lit(0)),
        ),
        F.lit(0).cast("long"),
        lambda total, n: total + n,
    )
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    left = F.col("n_words") - F.col("n_removed")
    return (
        made.join(frequent, "host", "left")
        .withColumn("n_removed", F.coalesce(F.when(F.col("frequent").isNotNull(), removed), F.lit(0)))
        .select(
            F.col("id").alias(id_column),
            *FIGURES,
            failed.alias("base_failed"),
            "n_removed",
            (~failed & (left >= least_left * F.col("n_words"))).alias("kept"),
        )
    )
