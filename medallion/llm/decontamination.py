"""Benchmark passages in documents, by a positional inverted index.

Method: the index stores (term, text, position) of training tokens, each file sorted by term.
A benchmark window is looked up from its rarest terms. Exact phrases: their postings, moved by
the term's place in the item, are intersected, which gives the place where the item would have
to start. Proximity: their postings are intersected within a stretch of words, whatever their
order. Only there are the document's words compared with the window's, so both are exact:
a phrase has the window's words in a row, a near match has each of them within ``SPAN`` words.

Only terms that lookups start from are stored, so the first pass over the texts counts the
benchmark's terms (reduced in each partition before a shuffle of one row per term), and the
second stores the postings of the rarest, with a row for each document that has its id and
number of words. A third reads the texts of candidates alone. The benchmark side is broadcast if
its bytes have been measured to be few, else joined. Texts are named by a 64-bit hash, so copies
are matched once and ids may be null or repeated. Built-in expressions only.

Defined cases: a null or wordless text or item has no words and matches nothing; an item with a
null id takes part in hits but is not named; an empty table on either side gives no hits; a text
hit by several items counts each word once; a window that repeats a word is near where that word
stands once; clashing columns are never read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.llm.store import broadcast_within, free, parts, stored

WINDOW = 13
RAREST = 2  # terms whose postings are intersected for each window
SPAN = 2 * WINDOW  # words in which a near match has all words of a window
ITEMS = 10_000  # benchmark items for a file of what is derived from them
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Lower-cased (A-Z) runs of digits, letters and non-ASCII characters; null: none."""
    folded = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(folded, "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"), "")


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def items(benchmark: DataFrame, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """``item`` (a number for each row), ``item_id`` and its ``words``, none without words."""
    rows = benchmark.select(
        benchmark[id_column].cast("string").alias("item_id"),
        words(benchmark[text_column]).alias("words"),
    )
    rows = rows.where(F.size("words") > 0).groupBy("words").agg(F.collect_set("item_id").alias("item_ids"))
    return stored(rows.select(F.xxhash64("words").alias("item"), "item_ids", "words"), "items", parts(benchmark, ITEMS))


def _tokens(docs: DataFrame) -> DataFrame:
    """``docs`` with key and text as key, pos and the term's hash."""
    tokens = docs.select("key", F.posexplode(words(F.col("text"))).alias("pos", "word"))
    return tokens.select("key", "pos", F.xxhash64("word").alias("term"))


def _terms(found: DataFrame) -> DataFrame:
    """Item, place and hash of every item word."""
    places = found.select("item", F.posexplode("words").alias("place", "word"))
    return places.select("item", "place", F.xxhash64("word").alias("term"))


def term_counts(docs: DataFrame, found: DataFrame) -> DataFrame:
    """How often each item term stands in ``docs``; terms that do not are left out."""
    files_ = parts(found, ITEMS)
    terms = broadcast_within(stored(_terms(found).select("term").distinct(), "terms", files_))
    counted = _tokens(docs).join(terms, "term").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return stored(counted, "counts", files_)


def anchors(found: DataFrame, counts: DataFrame, rarest: int, size: int) -> DataFrame:
    """Per item: ``lookups``, for each window the places of its rarest terms, and ``near``, the
    start of each window with its rarest different terms. Windows with a term that the documents
    do not have are left out, and so are items without a window."""
    placed = (
        _terms(found)
        .join(counts, "term", "left")
        .groupBy("item")
        .agg(F.array_sort(F.collect_list(F.struct("place", "n", "term"))).alias("terms"))
    )
    length = F.least(F.lit(size), F.size("terms"))
    starts = F.sequence(F.lit(1), F.size("terms") - length + 1)
    windows = F.transform(starts, lambda s: F.slice("terms", s, length))
    possible = F.filter(windows, lambda w: F.forall(w, lambda t: t["n"].isNotNull()))
    by_count = F.transform(
        possible, lambda w: F.array_sort(F.transform(w, lambda t: F.struct(t["n"], t["place"], t["term"])))
    )
    lookups = F.array_distinct(F.transform(by_count, lambda w: F.slice(w, 1, rarest)))
    different = F.transform(
        possible, lambda w: F.array_distinct(F.array_sort(F.transform(w, lambda t: F.struct(t["n"], t["term"]))))
    )
    near = F.transform(
        F.arrays_zip(
            F.transform(possible, lambda w: w[0]["place"]).alias("start"),
            F.transform(different, lambda w: F.slice(w["term"], 1, rarest)).alias("terms"),
        ),
        lambda e: F.struct(e["start"].alias("start"), e["terms"].alias("terms")),
    )
    return placed.select("item", lookups.alias("lookups"), near.alias("near")).where(F.size("lookups") > 0)


def index(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The stored postings (term, key, pos) of the terms that ``chosen`` lookups start from.
    A null term marks the end of a document: ``id``, which is null elsewhere, and in ``pos``
    the number of its words."""
    terms = F.concat(F.flatten("lookups")["term"], F.flatten(F.col("near")["terms"]))
    terms = chosen.select(F.explode(terms).alias("anchor"))
    anchor = broadcast_within(stored(terms.distinct(), "anchors", parts(chosen, ITEMS)))
    ended = F.concat(words(F.col("text")), F.array(F.lit(None).cast("string")))
    tokens = docs.select("id", "key", F.posexplode(ended).alias("pos", "word"))
    end = F.col("word").isNull()
    tokens = tokens.select(
        F.when(end, F.col("id")).alias("id"), "key", "pos", F.when(~end, F.xxhash64("word")).alias("term")
    )
    postings = tokens.join(anchor, F.col("term") == F.col("anchor"), "left")
    postings = postings.where("term is null or anchor is not null").select("term", "key", "pos", "id")
    return stored(postings.sortWithinPartitions("term", "key", "pos"), "postings")


def aligned(postings: DataFrame, chosen: DataFrame) -> DataFrame:
    """(key, item, shift) where all rarest terms of some window stand at their places, if the
    item began at word ``shift`` of the text, which may be before its first."""
    places = chosen.select("item", F.explode(F.array_distinct(F.flatten("lookups"))).alias("t")).select(
        "item", F.col("t.place").alias("place"), F.col("t.term").alias("term")
    )
    wanted = chosen.select("item", F.transform("lookups", lambda w: w["place"]).alias("wanted"))
    files_ = parts(chosen, ITEMS)
    met = (
        postings.join(broadcast_within(stored(places, "places", files_)), "term")
        .select("key", "item", (F.col("pos") - F.col("place")).alias("shift"), "place")
        .groupBy("key", "item", "shift")
        .agg(F.collect_set("place").alias("met"))
    )
    complete = F.exists("wanted", lambda w: F.size(F.array_except(w, F.col("met"))) == 0)
    return met.join(broadcast_within(stored(wanted, "wanted", files_)), "item").where(complete).select("key", "item", "shift")


def close(postings: DataFrame, chosen: DataFrame, span: int) -> DataFrame:
    """(key, item, bucket, starts): the windows of which all rarest terms stand in the words from
    ``bucket * span`` on, twice ``span`` of them. Each stretch of ``span`` words lies in one."""
    files_ = parts(chosen, ITEMS)
    terms = chosen.select("item", F.explode(F.array_distinct(F.flatten(F.col("near")["terms"]))).alias("term"))
    bucket = F.floor(F.col("pos") / span).cast("int")
    met = (
        postings.join(broadcast_within(stored(terms, "near-terms", files_)), "term")
        .select("key", "item", "term", F.explode(F.array(bucket, bucket - 1)).alias("bucket"))
        .groupBy("key", "item", "bucket")
        .agg(F.collect_set("term").alias("met"))
    )
    wanted = broadcast_within(stored(chosen.select("item", "near"), "near", files_))
    within = F.filter("near", lambda w: F.size(F.array_except(w["terms"], F.col("met"))) == 0)
    rows = met.join(wanted, "item").select("key", "item", "bucket", within["start"].alias("starts"))
    return rows.where(F.size("starts") > 0)


def texts_of(docs: DataFrame, candidates: list[DataFrame]) -> DataFrame:
    """The stored words (key, own) of each text that a candidate names."""
    keys = candidates[0].select("key")
    for more in candidates[1:]:
        keys = keys.union(more.select("key"))
    keys = stored(keys.distinct(), "keys", parts(candidates[0]))
    texts = docs.join(broadcast_within(keys), "key", "left_semi").groupBy("key").agg(F.first("text").alias("text"))
    return stored(texts.select("key", words(F.col("text")).alias("own")), "texts")


def exact_hits(texts: DataFrame, candidates: DataFrame, found: DataFrame, size: int) -> DataFrame:
    """(key, item, position): the words of a text that lie in a window of the item."""
    rows = candidates.join(broadcast_within(found.select("item", "words")), "item").join(texts, "key")
    length = F.least(F.lit(size), F.size("words"))
    equal = F.transform(
        "words",
        lambda w, k: F.when(
            (F.col("shift") + k >= 0) & (w == F.get("own", F.col("shift") + k)), F.lit("1")
        ).otherwise(F.lit("0")),
    )
    rows = rows.select("key", "item", "shift", length.alias("length"), F.array_join(equal, "").alias("equal"))
    starts = F.filter(
        F.sequence(F.lit(0), F.length("equal") - F.col("length")),
        lambda s: F.substr("equal", s + 1, F.col("length")) == F.repeat(F.lit("1"), F.col("length")),
    )
    begin = F.col("shift") + F.col("start")
    return (
        rows.select("key", "item", "shift", "length", F.explode(starts).alias("start"))
        .select("key", "item", F.explode(F.sequence(begin, begin + F.col("length") - 1)).alias("position"))
        .distinct()
    )


def near_hits(texts: DataFrame, candidates: DataFrame, found: DataFrame, size: int, span: int) -> DataFrame:
    """(key, item, first, last): for each window and bucket of ``candidates`` the shortest
    stretch of at most ``span`` words with all words of the window; the earliest of equal ones."""
    begin = F.greatest(F.col("bucket"), F.lit(0)) * span
    length = F.when(F.col("bucket") < 0, F.lit(span)).otherwise(F.lit(2 * span))
    rows = (
        candidates.join(texts, "key")
        .select("key", "item", "starts", begin.alias("begin"), F.slice("own", begin + 1, length).alias("stretch"))
        .join(broadcast_within(found.select("item", "words")), "item")
        .select("key", "item", "begin", "stretch", F.explode("starts").alias("start"), "words")
        .select("key", "item", "begin", "stretch", F.array_distinct(F.slice("words", F.col("start") + 1, size)).alias("w"))
        .where(F.size(F.array_except("w", "stretch")) == 0)
    )

    def ending(s: Column) -> Column:
        places = F.transform("w", lambda w: F.array_position(F.slice("stretch", s + 1, span), w))
        return F.when(F.array_min(places) > 0, F.struct(F.array_max(places).alias("n"), s.alias("s")))

    own = F.sequence(F.lit(0), F.size("stretch") - 1)
    own = F.filter(own, lambda s: F.array_contains("w", F.get("stretch", s)))
    best = rows.select("key", "item", "begin", F.array_min(F.transform(own, ending)).alias("best")).where("best is not null")
    first = F.col("begin") + F.col("best.s")
    return best.select(
        "key", "item", first.cast("int").alias("first"), (first + F.col("best.n") - 1).cast("int").alias("last")
    ).distinct()


class Search(NamedTuple):
    """What a search of documents for items has stored."""

    found: DataFrame  # per text with a match: key, n_hit, hit_items, near_items
    sizes: DataFrame  # per document: id, key, n_words
    near: DataFrame  # key, item_ids, first and last word of each near match


def search(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_column: str | None = None,
    text_column: str = "text",
    size: int = WINDOW,
    rarest: int = RAREST,
    span: int = SPAN,
) -> Search:
    """Exact and near matches of the items, both from one index. ``n_hit`` counts the words in
    exact windows, ``hit_items`` names their items, ``near_items`` those with a near window."""
    named = docs[id_column] if id_column else F.lit(None).cast("string")
    docs = docs.select(named.alias("id"), text_key(docs[text_column]).alias("key"), docs[text_column].alias("text"))
    found = items(benchmark)
    chosen = anchors(found, term_counts(docs, found), rarest, size)
    chosen = stored(chosen, "lookups", parts(found, ITEMS))
    tokens = index(docs, chosen)
    postings = tokens.where("term is not null")
    phrases = stored(aligned(postings, chosen), "candidates")
    stretches = stored(close(postings, chosen, span), "near-candidates")
    texts = texts_of(docs, [phrases, stretches])
    hits = stored(exact_hits(texts, phrases, found, size), "hits")
    near = stored(near_hits(texts, stretches, found, size, span), "near-hits")
    ids = broadcast_within(found.select("item", "item_ids"))

    def item_ids(rows: DataFrame, name: str) -> DataFrame:
        rows = rows.select("key", "item").distinct().join(ids, "item").groupBy("key")
        return rows.agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias(name))

    counted = hits.groupBy("key").agg(F.countDistinct("position").alias("n_hit"))
    exact = counted.join(item_ids(hits, "hit_items"), "key")
    matched = exact.join(item_ids(near, "near_items"), "key", "full")
    return Search(
        stored(matched, "matches", parts(hits)),
        tokens.where("term is null").select("id", "key", F.col("pos").cast("long").alias("n_words")),
        near.join(ids, "item").select("key", "item_ids", "first", "last"),
    )


def matches(docs: DataFrame, benchmark: DataFrame, **options: object) -> DataFrame:
    """Per text with a match: ``key``, ``n_hit`` (words in windows, null if only near),
    ``hit_items`` and ``near_items`` (ids, or null). Options as in ``search``."""
    return search(docs, benchmark, **options).found


def _verdict(rows: DataFrame, found: DataFrame, id_column: str) -> DataFrame:
    rows = rows.join(broadcast_within(found), F.col("_key") == F.col("key"), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    ids = F.coalesce("hit_items", F.array().cast("array<string>"))
    near = F.coalesce("near_items", F.array().cast("array<string>"))
    return rows.select(
        id_column,
        "n_words",
        n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        contaminated(n_hit, F.col("n_words")).alias("contaminated"),
        F.size(near).cast("long").alias("n_near_items"),
        F.sha2(F.array_join(near, ","), 256).alias("near_sha256"),
    )


def judged(docs: DataFrame, found: DataFrame, *, id_column: str = "doc_id", text_column: str = "text"):
    """The id of each row with the figures of its text in ``found`` and the verdict."""
    text = docs[text_column]
    rows = docs.select(
        docs[id_column], F.size(words(text)).cast("long").alias("n_words"), text_key(text).alias("_key")
    )
    return _verdict(rows, found, id_column)


def searched(docs: DataFrame, benchmark: DataFrame, *, id_column: str = "doc_id", **options: object) -> DataFrame:
    """``judged`` for the documents that are searched, without another pass over their texts."""
    result = search(docs, benchmark, id_column=id_column, **options)
    rows = result.sizes.select(F.col("id").alias(id_column), "n_words", F.col("key").alias("_key"))
    return _verdict(rows, result.found, id_column)


def contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (20 * n_hit >= n_words)


def without_contaminated(docs: DataFrame, found: DataFrame, *, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is not contaminated."""
    text = docs[text_column]
    key, hit = free("_key", docs.columns), free("_hit", docs.columns)
    found = found.where("n_hit > 0")
    keys = stored(found.select(F.col("key").alias(key), F.col("n_hit").alias(hit)), "hit-keys", parts(found))
    bad = (text_key(text) == F.col(key)) & contaminated(F.col(hit), F.size(words(text)))
    return docs.join(broadcast_within(keys), bad, "left_anti")


def proximity(
    docs: DataFrame, benchmark: DataFrame, *, text_column: str = "text", size: int = WINDOW, span: int = SPAN
) -> DataFrame:
    """(key, item_ids, first, last): stretches of at most ``span`` words that hold every word of a
    window of an item, in any order; of a window the shortest in each two ``span`` of words."""
    return search(docs, benchmark, text_column=text_column, size=size, span=span).near
