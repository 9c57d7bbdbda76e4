"""Near-duplicate documents by bottom-k sketches and exact Jaccard similarity.

Method: one hash function over five-word shingles; a document's sketch is its ``SKETCH`` least
hash values. Documents with equal sets form a class and go on as one. Inverted lists of
retained values generate overlaps, the sketch of the union estimates the similarity, and what
passes is confirmed on the full sets.

What makes it whole and bounded:

- Two sets with similarity 0.75 share about 48 of 64 retained values, and at least 24 but for a
  chance of about 5e-11 (sets of up to 64 shingles are retained whole). So of a sketch of n
  values, ordered from rare to frequent, the first n - 23 suffice for two linked documents to
  meet in a list. A passage that thousands of documents share is frequent, so its lists are
  left out unless it is most of the document, and then those documents are copies.
- A list is not expanded into its pairs. Its members are compared with its leader, the most
  central of them, and links merge components; lists then left with one component are done. Of
  the others, classes go that cannot be linked with any: two sets share at most what one of them
  shares with all open classes together, and their union has the shingles that the other has
  alone. So pages of one template that differ in a seventh of their text or more go here. The
  rest are grouped by leader and compared in pairs of blocks of about ``BLOCK`` classes and
  ``BLOCK_VALUES`` shingles, inside a task, first on their sketches, which leaves the classes
  that some other in the two blocks resembles by its union sketch, then these on their full
  sets, by matrix products. Tasks emit classes and links only; blocks of one component are not
  compared with each other. So no link between different components is missed, no task has more
  than two blocks, and no table has a row for every pair. Classes that pass all this and are
  not linked cost comparisons that grow with the square of their number in a list.
- Hot values, classes and components are only hot keys of partial aggregations or of joins
  against one row per key, which adaptive execution splits.

Defined cases: null or wordless texts have no shingles, are linked with nothing and are kept;
texts of fewer words are one shingle; rows that share an id share a component only through
their texts; the component's id is the least non-null id in it; other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from medallion.llm.arrays import blocks, hash_runs, mix, per_text, random_words, runs, utf8, window_hashes
from medallion.llm.components import components
from medallion.llm.store import broadcast_within, parts, stored

SHINGLE = 5
SKETCH = 64
SHARED = 24  # retained values that linked documents share at least
LEAST_ESTIMATE = 0.43  # six standard deviations below 0.75 for 64 values
BLOCK = 256  # classes, compared with as many in one task
BLOCK_VALUES = 1 << 20  # shingles of a block's classes
BAND = 1.34  # sets in one band of sizes; sizes of linked sets are within 4/3
PAIRS = 4096  # union sketches made at once
COLUMNS = 8192  # shared shingles per matrix product
TEXTS = 5_000  # texts in a file
_NONE = np.iinfo(np.int64).max  # no value
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = utf8(column)
    for first, end, part, bounds in blocks(data, offsets):
        part = _FOLD[part]
        starts, ends = runs(~_SPACE[part], bounds)
        words = hash_runs(part, starts, ends)
        hashes = window_hashes(words, SHINGLE, 5).view(np.int64)
        at = per_text(starts, bounds)
        for k in range(end - first):
            own = hashes[at[k] : max(at[k + 1] - SHINGLE + 1, at[k])]
            if not len(own) and at[k + 1] > at[k]:
                few = words[at[k] : at[k + 1]]
                with np.errstate(over="ignore"):
                    own = mix(np.array([(few * random_words(len(few), 90 + len(few))).sum()])).view(np.int64)
            yield np.unique(own)


def _digest(values: np.ndarray) -> int | None:
    """A hash of a set of values."""
    if not len(values):
        return None
    with np.errstate(over="ignore"):
        total = mix(values.view(np.uint64) + np.uint64(17)).sum() + np.uint64(len(values))
        return int(mix(np.array([total])).view(np.int64)[0])


def sketches(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``id``, ``n`` (shingles), ``class`` (hash of the set, null if empty) and ``sketch``."""
    chosen = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [(len(s), _digest(s), s[:SKETCH].copy()) for s in shingle_sets(batch.column(1))]
            n, digest, least = zip(*sets, strict=True) if sets else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(digest, pa.int64()),
                    pa.array(least, pa.list_(pa.int64())),
                ],
                ["id", "n", "class", "sketch"],
            )

    schema = StructType([chosen.schema["id"]]).add("n", LongType()).add("class", LongType())
    return chosen.mapInArrow(work, schema.add("sketch", ArrayType(LongType())))


def inverted_lists(classes: DataFrame) -> DataFrame:
    """(value, class) for the retained values by which a class can meet a linked one."""
    entries = classes.select("class", F.size("sketch").alias("size"), F.explode("sketch").alias("value"))
    shared = entries.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = stored(shared, "values")
    needed = F.least(F.lit(SHARED), F.ceil(F.col("size") * 0.75)).cast("int")
    found = (
        entries.join(shared, "value")
        .groupBy("class", "size")
        .agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("met"))
    )
    # values that no other class has come first in the order and lead nowhere
    places = F.col("size") - needed + 1 - (F.col("size") - F.size("met"))
    weight = F.aggregate("met", F.lit(0).cast("long"), lambda total, e: total + e["df"])
    lists = found.where(places > 0).select(
        "class", weight.alias("weight"), F.explode(F.slice("met", F.lit(1), places.cast("int"))).alias("e")
    )
    return lists.select(F.col("e.value").alias("value"), "class", "weight")


def _sketch_rows(column: pa.Array) -> np.ndarray:
    """Sketches as the rows of a matrix, filled up with ``_NONE``."""
    sizes = column.value_lengths().to_numpy()
    made = np.full((len(sizes), SKETCH), _NONE)
    made[np.arange(SKETCH) < sizes[:, None]] = column.flatten().to_numpy()
    return made


def _suggested(left: np.ndarray, right: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For rows ``x`` of ``left`` and ``y`` of ``right``, whether the sketch of the union, its
    least ``SKETCH`` values, suggests enough similarity by those that are in both."""
    good = np.zeros(len(x), bool)
    for start in range(0, len(x), PAIRS):
        part = slice(start, start + PAIRS)
        every = np.sort(np.concatenate([left[x[part]], right[y[part]]], axis=1), axis=1)
        real = every != _NONE
        again = np.zeros(every.shape, bool)
        again[:, 1:] = (every[:, 1:] == every[:, :-1]) & real[:, 1:]
        rank = np.cumsum(real & ~again, axis=1)
        both = (again & (rank <= SKETCH)).sum(axis=1)
        good[part] = both >= LEAST_ESTIMATE * np.minimum(rank[:, -1], SKETCH)
    return good


def _estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose sketches' union suggests enough similarity."""
    a = classes.select(F.col("class").alias("a"), F.col("sketch").alias("sa"))
    b = classes.select(F.col("class").alias("b"), F.col("sketch").alias("sb"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.arange(batch.num_rows)
            good = _suggested(*(_sketch_rows(c) for c in batch.columns[2:]), rows, rows)
            yield batch.select([0, 1]).filter(pa.array(good))

    return (
        pairs.join(a, "a").join(b, "b").select("a", "b", "sa", "sb").mapInArrow(work, "a long, b long")
    )


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``class`` and one ``text`` for each class in ``wanted`` (class, id): the rows with these
    ids, by the class of their text, since an id may stand on several rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = pa.array([_digest(s) for s in shingle_sets(batch.column(0))], pa.int64())
            yield pa.RecordBatch.from_arrays([digests, batch.column(0)], ["class", "text"])

    ids = broadcast_within(wanted.select(F.col("id").alias("wanted")).distinct())
    rows = docs.join(ids, F.col("id").eqNullSafe(F.col("wanted")), "left_semi").select("text")
    found = rows.mapInArrow(work, "class long, text string")
    found = found.join(wanted.select("class"), "class", "left_semi")
    return found.groupBy("class").agg(F.first("text").alias("text"))


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs with 100 * intersection >= 75 * union. ``texts``: class and text."""
    a = texts.select(F.col("class").alias("a"), F.col("text").alias("ta"))
    b = texts.select(F.col("class").alias("b"), F.col("text").alias("tb"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets: dict[int, np.ndarray] = {}
            names = [c.to_pylist() for c in batch.columns[:2]]
            for ids, column in zip(names, batch.columns[2:], strict=True):
                where = {c: k for k, c in enumerate(ids) if c not in sets}
                chosen = column.take(pa.array(list(where.values()), pa.int64()))
                sets.update(zip(where, shingle_sets(chosen), strict=True))
            good = []
            for x, y in zip(*names, strict=True):
                both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                good.append(100 * both >= 75 * (len(sets[x]) + len(sets[y]) - both))
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return pairs.join(a, "a").join(b, "b").select("a", "b", "ta", "tb").mapInArrow(work, "a long, b long")


def _ordered(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _sets(texts: DataFrame) -> DataFrame:
    """class and ``shingles``, the sorted hashes of its set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch.column(1)))
            ends = np.cumsum([0] + [len(s) for s in sets])
            values = np.concatenate(sets) if sets else np.empty(0, np.int64)
            made = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), made], ["class", "shingles"])

    return texts.select("class", "text").mapInArrow(work, "class long, shingles array<long>")


def _set_sizes(sets: DataFrame) -> DataFrame:
    """class, ``n`` (shingles) and ``m``, how many of them another of these classes has."""
    values = sets.select("class", F.explode("shingles").alias("value"))
    # a sum, a least and a largest class tell apart one class from several without a join
    several = values.groupBy("value").agg(
        F.count(F.lit(1)).alias("df"), F.min("class").alias("class"), F.max("class").alias("other")
    )
    alone = several.where("df = 1").groupBy("class").agg(F.count(F.lit(1)).alias("alone"))
    sizes = sets.select("class", F.size("shingles").cast("long").alias("n"))
    return sizes.join(alone, "class", "left").select(
        "class", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("m")
    )


def _open_members(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """``lists`` with ``component``, as far as a list has several of them."""
    members = lists.join(labels, lists["class"] == labels["node"], "left").select(
        *lists.columns, F.coalesce("component", "class").alias("component")
    )
    files_ = parts(lists)
    members = stored(members, "members", files_)
    several = members.groupBy("value").agg(F.min("component").alias("i"), F.max("component").alias("j"))
    # stored, so that a hot list on the other side of the join can be split
    several = stored(several.where("i < j").select("value"), "several", files_)
    return stored(members.join(several, "value", "left_semi"), "open", files_)


def _may_link(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """Classes that may be linked with another in one of their lists.

    A class shares at most ``m`` shingles with it, and their union has its own ``n`` and those
    that the other has alone, at least the least such number in the list among sets of a size
    that could be linked, which are in the same band of sizes or the next to it.
    """
    band = F.floor(F.log("n") / float(np.log(BAND))).alias("band")
    sized = members.select("value", "class").distinct()
    sized = sized.join(sizes, "class").select("value", "class", "n", "m", band)
    around = F.explode(F.array(*(F.col("band") + k for k in (-1, 0, 1)))).alias("band")
    least = sized.groupBy("value", "band").agg(F.min(F.col("n") - F.col("m")).alias("alone"))
    least = least.select("value", around, "alone").groupBy("value", "band").agg(F.min("alone").alias("alone"))
    # stored, so that a hot list on the other side of the join can be split
    least = stored(least, "alone", parts(members))
    found = sized.join(least, ["value", "band"]).where("4 * m >= 3 * (n + alone)")
    return found.select("class").distinct()


def _still_open(members: DataFrame, sets: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The members whose classes may be linked with one of another component, and the sizes of
    these classes. Repeated while classes go in number, since each makes others stand more alone."""
    left = members.select("class").distinct().count()
    while True:
        files_ = parts(members)
        open_ = stored(members.select("class").distinct(), "open-classes", files_)
        sizes = stored(_set_sizes(sets.join(open_, "class", "left_semi")), "sizes", files_)
        chosen = stored(_may_link(members, sizes), "may-link", files_)
        members = members.select("value", "class", "leader").join(chosen, "class")
        members = _open_members(members.select("value", "class", "leader"), labels)
        before, left = left, members.select("class").distinct().count()
        if left > 0.9 * before or not left:
            return members, sizes


def _units(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """class, component, ``n`` (shingles) and ``unit``: the classes that follow one leader, in which a component
    of more than ``BLOCK`` classes is a unit of its own, ``whole``."""
    led = members.groupBy("class", "component").agg(F.max("leader").alias("family"))
    wholes = led.groupBy("family", "component").agg(F.count(F.lit(1)).alias("c"))
    whole = F.when(F.col("c") > BLOCK, F.col("component"))
    wholes = wholes.select("family", "component", whole.alias("whole"))
    unit = F.xxhash64("family", F.coalesce("whole", F.lit(0)))
    led = led.join(wholes, ["family", "component"]).join(sizes.select("class", "n"), "class")
    return led.select("class", "component", "n", "whole", unit.alias("unit"))


def _counted(units: DataFrame) -> DataFrame:
    """unit and its number of ``blocks``."""
    filled = F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_VALUES)
    return units.groupBy("unit").agg(F.ceil(filled).cast("int").alias("blocks"))


def _block_pairs(members: DataFrame, units: DataFrame) -> DataFrame:
    """(a, i, b, j): blocks i of unit a and j of unit b, whose classes are to be compared,
    since a list has classes of both units and of several components."""
    here = members.select("value", "class").join(units.drop("n"), "class").select("value", "unit", "whole").distinct()
    here = stored(here, "here", parts(members))
    x = here.select("value", F.col("unit").alias("a"), F.col("whole").alias("wa"))
    y = here.select("value", F.col("unit").alias("b"), F.col("whole").alias("wb"))
    apart = F.coalesce(F.col("wa") != F.col("wb"), F.lit(True))
    pairs = x.join(y, "value").where((F.col("a") <= F.col("b")) & apart).select("a", "b").distinct()
    counts = _counted(units)
    pairs = pairs.join(counts.toDF("a", "na"), "a").join(counts.toDF("b", "nb"), "b")
    first = pairs.select("a", "b", "nb", F.explode(F.sequence(F.lit(0), F.col("na") - 1)).alias("i"))
    least = F.when(F.col("a") == F.col("b"), F.col("i")).otherwise(F.lit(0))
    return first.select("a", "i", "b", F.explode(F.sequence(least, F.col("nb") - 1)).alias("j"))


def _compared(members: DataFrame, units: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between classes of different components, over pairs of blocks.

    A task has two blocks, first the sketches of all their classes, then the sets of those that
    resemble one in the other, and emits links only.
    """
    files_ = parts(members)
    pairs = stored(_block_pairs(members, units), "block-pairs", files_)
    placed = units.join(_counted(units), "unit").select(
        "unit", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int").alias("block"), "class", "component"
    )
    sketch = F.slice("shingles", 1, SKETCH).alias("sketch")
    placed = stored(placed.join(sets.select("class", sketch), "class"), "placed", files_)

    def side(unit: str, block: str, number: int) -> DataFrame:
        on = (F.col("unit") == F.col(unit)) & (F.col("block") == F.col(block))
        return pairs.join(placed, on).select(
            F.xxhash64("a", "i", "b", "j").alias("task"), F.lit(number).alias("side"), "class", "component", "sketch"
        )

    def resemble(table: pa.Table) -> pa.Table:
        rows = _sketch_rows(table.column("sketch").combine_chunks())
        at, of = table.column("side").to_numpy(), table.column("component").to_numpy()
        left, right = np.flatnonzero(at == 0), np.flatnonzero(at == 1)
        held = [row[row != _NONE] for row in rows]
        both = _intersections([held[k] for k in left], [held[k] for k in right])
        needed = np.minimum(SHARED, np.ceil(0.75 * np.array([len(s) for s in held])))
        apart = of[left][:, None] != of[right][None, :]
        x, y = np.nonzero(apart & (both >= np.maximum(needed[left][:, None], needed[right][None, :])))
        good = _suggested(rows[left], rows[right], x, y)
        return table.take(np.union1d(left[x[good]], right[y[good]])).drop_columns("sketch")

    def compare(table: pa.Table) -> pa.Table:
        shingles = table.column("shingles").combine_chunks()
        ends = np.cumsum(shingles.value_lengths().to_numpy())
        sets = np.split(shingles.flatten().to_numpy(), ends[:-1])
        at, classes, of = (table.column(c).to_numpy() for c in ("side", "class", "component"))
        left, right = np.flatnonzero(at == 0), np.flatnonzero(at == 1)
        both = _intersections([sets[k] for k in left], [sets[k] for k in right])
        sizes = np.array([len(s) for s in sets])
        union = sizes[left][:, None] + sizes[right][None, :] - both
        linked = (100 * both >= 75 * union) & (of[left][:, None] != of[right][None, :])
        x, y = np.nonzero(linked)
        a, b = classes[left[x]], classes[right[y]]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    rows = side("a", "i", 0).union(side("b", "j", 1))
    near = rows.groupBy("task").applyInArrow(resemble, "task long, side int, class long, component long")
    near = stored(near, "near")
    return near.join(sets, "class").groupBy("task").applyInArrow(compare, "a long, b long")


def _intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many values each set of ``left`` shares with each of ``right``."""
    total = np.zeros((len(left), len(right)))
    if not left or not right:
        return total
    x, y = np.concatenate(left), np.concatenate(right)
    shared = np.intersect1d(x, y)
    rows = [np.repeat(np.arange(len(s)), [len(v) for v in s]) for s in (left, right)]
    places = []
    for values, row in ((x, rows[0]), (y, rows[1])):
        at = np.searchsorted(shared, values)
        at[at == len(shared)] = 0
        met = shared[at] == values if len(shared) else np.zeros(len(values), bool)
        places.append((row[met], at[met]))
    for start in range(0, len(shared), COLUMNS):
        parts = []
        for size, (row, at) in zip((len(left), len(right)), places, strict=True):
            chosen = (at >= start) & (at < start + COLUMNS)
            part = np.zeros((size, min(COLUMNS, len(shared) - start)), np.float32)
            part[row[chosen], at[chosen] - start] = 1
            parts.append(part)
        total += parts[0] @ parts[1].T
    return total


def link(lists: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame | None:
    """``node`` and ``component`` of the classes that are linked and not the least of theirs.

    ``lists``: value, class and weight; ``classes``: class and sketch, ``texts``: class and
    text, a row for each class in the lists.
    """
    if not lists.limit(1).count():
        return None
    # the member whose values are most common is the one nearest to the others of a group
    files_ = parts(lists)
    leader = F.max(F.struct("weight", "class"))["class"]
    leaders = stored(lists.groupBy("value").agg(leader.alias("leader")), "leaders", files_)
    lists = stored(lists.join(leaders, "value").select("value", "class", "leader"), "led", files_)
    stars = lists.where("class <> leader").select(*_ordered(F.col("class"), F.col("leader"))).distinct()
    labels = components(_confirmed(_estimated(stars, classes), texts), files_)

    members = _open_members(lists, labels)
    open_ = stored(members.select("class").distinct(), "first-open", files_)
    sets = stored(_sets(texts.join(open_, "class", "left_semi")), "sets", parts(open_, TEXTS))
    members, sizes = _still_open(members, sets, labels)
    units = stored(_units(members, sizes), "units", files_)
    links = _compared(members, units, sets)
    return components(links.union(labels.select("node", "component")), files_)


def near_duplicates(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id of each row with ``n_shingles``, ``component_id`` and ``kept``."""
    made = stored(sketches(docs, id_column, text_column), "sketches")
    classes = stored(
        made.where("class is not null").select("class", "sketch").dropDuplicates(["class"]), "classes"
    )
    lists = stored(inverted_lists(classes), "lists")
    listed = stored(lists.select("class").distinct(), "listed", parts(lists))
    wanted = made.select("class", "id").join(listed, "class").groupBy("class").agg(F.min("id").alias("id"))
    named = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))
    wanted = stored(wanted, "wanted", parts(listed))
    texts = stored(_texts(named, wanted), "texts", parts(wanted, TEXTS))
    labels = link(lists, classes.join(listed, "class"), texts)
    if labels is None:
        labels = docs.sparkSession.createDataFrame([], "node long, component long")
    of = made.select("id", "n", "class").join(labels, F.col("class") == F.col("node"), "left")
    of = of.select("id", "n", F.coalesce("component", "class").alias("component"))
    least = (
        of.where("component is not null")
        .groupBy("component")
        .agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("c"))
        .where("c > 1")
    )
    # stored, so that a component with many documents can be split in the join
    least = stored(least.drop("c"), "least", parts(made))
    result = of.join(least, "component", "left")
    component = F.when(F.col("component").isNull(), F.col("id")).otherwise(F.coalesce("least", "id"))
    return result.select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
