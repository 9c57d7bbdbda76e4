"""Line removal by frequency within a site.

Method: pages are grouped by host, each distinct line is counted once per page, the count is
divided by the host's number of pages, and lines above a ratio are dropped from all pages of
that host. Lines compare after white space is collapsed and A-Z lower-cased. A line must also
stand on ``min_pages`` pages: on fewer, nothing tells boilerplate from a line that is the page's own.

The counts are reduced inside each partition before their only shuffle, whatever share of the
pages one host has. A host has at most (distinct lines per page) / ratio such lines, so they
travel as one array per host; hosts are broadcast only if the arrays have been measured to
be small, else joined, where adaptive execution splits a hot host. Only built-in expressions.

Defined cases: a null host counts as the empty one; a null text stays null, an empty one
empty; blank lines are never counted or dropped; repeated rows are separate pages; an empty
table gives no rows; other columns are carried along, whatever their names, but for
``n_lines`` and ``n_dropped``, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.store import free, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BROADCAST_LINES = 500_000  # 8 bytes each
MIN_PAGES = 3


def normalised(line: Column) -> Column:
    """White space collapsed to single spaces and removed at the ends, A-Z lower-cased."""
    spaced = F.regexp_replace(line, "[ \\t\\x0B\\f\\r]+", " ")
    return F.translate(F.trim(spaced), UPPER, LOWER)


def frequent_lines(docs: DataFrame, host: Column, text: Column, ratio: float, min_pages: int):
    """One row per host that has such lines: ``host`` and ``lines``, their hashes."""
    pages = docs.select(F.coalesce(host, F.lit("")).alias("host"), text.alias("text"))
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    lines = F.array_distinct(F.transform(F.split("text", "\n"), normalised))
    counted = (
        pages.select("host", F.explode(lines).alias("line"))
        .where("line <> ''")
        .groupBy("host", F.xxhash64("line").alias("line"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_pages)
    )
    return (
        counted.join(totals, "host")
        .where(F.col("n") > F.lit(ratio) * F.col("pages"))
        .groupBy("host")
        .agg(F.array_sort(F.collect_set("line")).alias("lines"))
    )


def drop_frequent_lines(
    docs: DataFrame,
    *,
    host_column: str = "source",
    text_column: str = "text",
    ratio: float = 0.1,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """``docs`` with the text reduced, and ``n_lines``, ``n_dropped`` (lines with a word)."""
    found = stored(
        frequent_lines(docs, docs[host_column], docs[text_column], ratio, min_pages), "lines"
    )
    size = found.agg(F.coalesce(F.sum(F.size("lines")), F.lit(0))).first()[0]
    host, bad, whole, norms, left = (free(c, docs.columns) for c in ("_host", "_bad", "_whole", "_norms", "_left"))
    found = found.select(F.col("host").alias(host), F.col("lines").alias(bad))
    if size <= BROADCAST_LINES:
        found = F.broadcast(found)
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    joined = docs.join(found, F.coalesce(docs[host_column], F.lit("")) == F.col(host), "left")
    # each line is normalised once, here
    split = F.split(docs[text_column], "\n")
    rows = joined.select(
        *(docs[c] for c in names), F.col(bad), split.alias(whole), F.transform(split, normalised).alias(norms)
    )

    def kept(line: Column, k: Column) -> Column:
        norm = F.get(norms, k)
        return ~((norm != "") & F.coalesce(F.array_contains(bad, F.xxhash64(norm)), F.lit(False)))

    lines = F.when(F.col(bad).isNull(), F.col(whole)).otherwise(F.filter(whole, kept))
    worded = F.size(F.filter(norms, lambda norm: norm != ""))
    rows = rows.select(*names, whole, lines.alias(left), worded.alias(norms))
    return rows.select(
        *(F.array_join(left, "\n").alias(c) if c == text_column else F.col(c) for c in names),
        F.coalesce(F.greatest(norms, F.lit(0)), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(whole) - F.size(left), F.lit(0)).cast("long").alias("n_dropped"),
    )
