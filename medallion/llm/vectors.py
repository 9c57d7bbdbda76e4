"""Near-duplicate embeddings by counting collisions on sorted projections.

Method: unit vectors are projected on many random directions. On each, the rows of a block are
sorted and every query takes the window of values centred at its own. A pair's collisions are
counted over all directions; pairs with at least the calibrated count are verified by their
cosine in double precision. For directions of normal numbers the difference of two projections
is normal with the distance of the vectors as its deviation, so the chance to collide is known
at the cosine that is asked for, and the least count is the quantile of a binomial law
(``least_count``).

What makes it whole and bounded:

- Whether two vectors are linked follows from these two alone: cells and blocks divide the work
  and drop no pair, so neither the size of a table nor the other vectors change a link.
- Equal vectors of one label form a class, which goes on as one with its weight.
- A group (label and dimension) of up to ``LEAF`` classes is one cell. In a larger one some
  classes are pivots, and a class belongs to the region of the pivot that it is most like. Cells
  are made of regions. A class is also looked up in each earlier cell with a region that it is
  not too far from: the plane between two regions is at most as far from a vector as any vector
  behind it, so no linked pair is missed. Where vectors form clusters, few cells are near; where
  they lie in all directions, all are, and the pairs compared grow with the square.
- A cell that has, or is looked up by, more classes than ``LEAF`` is divided by hash, and its
  blocks are compared two by two. A task has two blocks of about ``LEAF`` classes, compares them
  in slices of ``CELLS`` pairs, and returns a row per class: its links, and the root of its tree.
  No table has a row for every pair.

Defined cases: a vector that is null, empty or zero, or has null or non-finite components, and a
row without a label, are linked with nothing and kept; vectors of different dimensions are not
compared; rows that share an id are separate vectors; a component's id is the least non-null id
in it; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, FloatType, IntegerType, LongType, StructType

from medallion.llm.components import components
from medallion.llm.store import broadcast_within, stored

COSINE = 0.93
COUNTED = 32  # directions on which collisions are counted
WINDOW = 1.5  # half a window, in deviations of a pair at the least cosine
LEAF = 16_384  # classes in a block
PIVOTS = 8  # pivots for each LEAF classes of a larger group, about
PIVOTS_AT_MOST = 2_048  # in all; what these do not divide is divided by hash
CELLS = 1 << 18  # pairs looked at together in a task
PAIRS = 1 << 16  # pairs verified together


def directions(dim: int, count: int, seed: int) -> np.ndarray:
    """``count`` fixed directions of independent normal numbers."""
    return np.random.default_rng([seed, dim]).standard_normal((dim, count))


def deviation(cosine: float) -> float:
    """Distance of two unit vectors, and so the deviation of their projections' difference."""
    return math.sqrt(2 - 2 * cosine)


def least_count(count: int = COUNTED, window: float = WINDOW, recall: float = 1 - 1e-4) -> int:
    """The greatest number of collisions that a pair at the least cosine reaches with the
    probability ``recall``; nearer pairs reach it more often."""
    p = math.erf(window / math.sqrt(2))
    missed = 0.0
    for k in range(count + 1):
        missed += math.comb(count, k) * p**k * (1 - p) ** (count - k)
        if missed > 1 - recall:
            return k
    return count


def packed(vectors: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """``id``, ``label`` and ``vec``: the components' bytes, scaled by a power of two so that no
    square overflows; null for a vector that cannot be compared."""
    chosen = vectors.select(
        vectors[id_column].alias("id"), vectors[label_column].alias("label"), vectors[vector_column].alias("v")
    )
    kind = np.float32 if isinstance(chosen.schema["v"].dataType.elementType, FloatType) else np.float64

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            values = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
            at = column.offsets.to_numpy()
            present = column.is_valid().to_numpy(zero_copy_only=False)
            out: list[bytes | None] = [None] * batch.num_rows
            for dim in np.unique(np.diff(at)[present]):
                rows = np.flatnonzero(present & (np.diff(at) == dim)) if dim else np.empty(0, np.int64)
                x = values[at[rows][:, None] + np.arange(dim)]
                largest = np.abs(x).max(axis=1, initial=0)
                good = np.isfinite(largest) & (largest > 0)
                scale = np.frexp(largest[good])[1]
                scaled = np.ldexp(x[good], -scale[:, None]).astype(kind)
                for row, vector in zip(rows[good], scaled, strict=True):
                    out[row] = vector.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["id", "label", "vec"]
            )

    schema = StructType([chosen.schema["id"], chosen.schema["label"]]).add("vec", BinaryType())
    return chosen.mapInArrow(work, schema)


def unit(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of a column of packed ones of equal size, and their lengths. Scaled vectors
    differ from the given ones by a factor, which no cosine has."""
    kind = np.float32 if width == 4 else np.float64
    data = b"".join(column.to_pylist())
    rows = np.frombuffer(data, kind).astype(np.float64)
    rows = rows.reshape(len(column), -1)
    return rows, np.sqrt(np.einsum("ij,ij->i", rows, rows))


def merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of each a and b in ``root``, in which every entry names its tree's least."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up


def linked_pairs(
    left: np.ndarray, right: np.ndarray, sizes: tuple[np.ndarray, np.ndarray], cosine: float, itself: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of pairs with at least that cosine, in slices. ``itself``: both sides are the
    same rows, of which each pair is wanted once."""
    if not len(left) or not len(right):
        return
    g = directions(left.shape[1], COUNTED, 11)
    window, least = WINDOW * deviation(cosine), least_count()
    x, y = left / sizes[0][:, None] @ g, right / sizes[1][:, None] @ g
    order = np.argsort(y, axis=0, kind="stable")
    kind = np.uint16 if len(right) < 1 << 16 else np.uint32
    place = np.empty((COUNTED, len(right)), kind)
    first, width = np.empty((COUNTED, len(left)), kind), np.empty((COUNTED, len(left)), kind)
    for j in range(COUNTED):
        values = y[order[:, j], j]
        place[j, order[:, j]] = np.arange(len(right))
        first[j] = np.searchsorted(values, x[:, j] - window, "left")
        width[j] = np.searchsorted(values, x[:, j] + window, "right") - first[j]
    step = max(1, CELLS // len(right))
    buffers = [np.empty(min(step, len(left)) * len(right), t) for t in (np.uint8, kind, bool)]
    for start in range(0, len(left), step):
        end, skip = min(start + step, len(left)), start + 1 if itself else 0
        shape = end - start, max(len(right) - skip, 0)
        met, gap, hit = (buffer[: shape[0] * shape[1]].reshape(shape) for buffer in buffers)
        met[:] = 0
        for j in range(COUNTED):  # a place before the window wraps around to a large number
            np.subtract(place[j, None, skip:], first[j, start:end, None], out=gap)
            np.less(gap, width[j, start:end, None], out=hit)
            np.add(met, hit.view(np.uint8), out=met)
        a, b = np.nonzero(met >= least)
        a, b = a + start, b + skip
        if itself:
            a, b = a[a < b], b[a < b]
        for k in range(0, len(a), PAIRS):
            i, o = a[k : k + PAIRS], b[k : k + PAIRS]
            near = np.einsum("ij,ij->i", left[i], right[o]) >= cosine * (sizes[0][i] * sizes[1][o])
            yield i[near], o[near]


def _compare(table: pa.Table, cosine: float, width: int) -> pa.Table:
    """A row for each linked class of a task: ``n``, the weight of its links, and ``root``."""
    table = table.combine_chunks()
    kind = table.column("kind").to_numpy()
    cls, weight = table.column("cls").to_numpy(), table.column("weight").to_numpy()
    rows, sizes = unit(table.column("vec"), width)
    n, root = np.zeros(len(kind), np.int64), np.arange(len(kind))
    itself = table.column("i")[0] == table.column("j")[0]
    left = np.flatnonzero(kind == 0)
    right = left if itself else np.flatnonzero(kind == 1)
    for a, b in linked_pairs(rows[left], rows[right], (sizes[left], sizes[right]), cosine, itself):
        a, b = left[a], right[b]
        merge(root, a, b)
        np.add.at(n, a, weight[b])
        np.add.at(n, b, weight[a])
    found = np.flatnonzero(n)
    return pa.table({"cls": cls[found], "n": n[found], "root": cls[root[found]]})


def _pivots(rows: DataFrame, large: DataFrame, leaf: int, width: int) -> dict[int, np.ndarray]:
    """Unit vectors that divide each of the ``large`` groups, by ``g``: a bounded choice by hash.
    Any choice gives the same links."""
    chosen = (
        rows.join(large, ["label", "dim"])
        .where(F.pmod(F.xxhash64("cls"), F.lit(leaf)) < PIVOTS)
        .dropDuplicates(["cls"])
        .orderBy(F.xxhash64("cls", F.lit(1)))
        .limit(PIVOTS_AT_MOST)
        .select("g", "vec")
        .toArrow()
    )
    of, pivots = chosen.column("g").to_numpy(), {}
    for g in np.unique(of):
        x, sizes = unit(chosen.column("vec").take(pa.array(np.flatnonzero(of == g))), width)
        pivots[int(g)] = x / sizes[:, None]
    return pivots


def distances(pivots: np.ndarray) -> np.ndarray:
    """Of each two pivots."""
    square = np.einsum("ij,ij->i", pivots, pivots)
    return np.sqrt(np.maximum(square[:, None] + square - 2 * pivots @ pivots.T, 0))


def near_cells(
    u: np.ndarray, pivots: np.ndarray, apart: np.ndarray, cells: int, cosine: float
) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each unit vector, and of (vector, cell) whether the cell may have a vector
    with at least that cosine. A region's vectors are at least as like its pivot as any other
    pivot, and unit vectors with that cosine are at most ``deviation`` apart, so nothing behind
    the plane between two pivots is near a vector that is further from the plane."""
    like = u @ pivots.T
    region = like.argmax(axis=1)
    # the margin is far above the error of a product or a distance
    reached = like.max(axis=1)[:, None] - like <= deviation(cosine) * apart[region] + 1e-6
    near = [reached[:, cell::cells].any(axis=1) for cell in range(cells)]
    return region % cells, np.stack(near, axis=1)


def _placed(rows: DataFrame, pivots: dict[int, np.ndarray], cosine: float, width: int, columns: list[str]) -> DataFrame:
    """``rows`` (with label, dim, vec, ``columns`` and, in a large group, its g and number of
    cells) once in their own cell, kind 0, and once in each earlier cell that may have a vector
    near them, kind 1."""
    out = ["label", "dim", *columns]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apart: dict[int, np.ndarray] = {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            of = table.column("g").fill_null(-1).to_numpy()
            for g in np.unique(of):
                part = table.take(pa.array(np.flatnonzero(of == g)))
                own, near = np.zeros(len(part), np.int64), np.zeros((len(part), 0), bool)
                if g in pivots:
                    x, sizes = unit(part.column("vec"), width)
                    cells = min(part.column("cells")[0].as_py(), len(pivots[g]))
                    if g not in apart:
                        apart[g] = distances(pivots[g])
                    own, near = near_cells(x / sizes[:, None], pivots[g], apart[g], cells, cosine)
                    near &= np.arange(cells) < own[:, None]
                at, cell = np.nonzero(near)
                kind = np.concatenate([np.zeros(len(part), np.int32), np.ones(len(at), np.int32)])
                at, cell = np.concatenate([np.arange(len(part)), at]), np.concatenate([own, cell])
                for k in range(0, len(at), 10_000):
                    some = part.select(out).take(pa.array(at[k : k + 10_000]))
                    some = some.append_column("cell", pa.array(cell[k : k + 10_000]))
                    some = some.append_column("kind", pa.array(kind[k : k + 10_000]))
                    yield from some.combine_chunks().to_batches()

    schema = StructType([rows.schema[c] for c in out]).add("cell", LongType()).add("kind", IntegerType())
    return rows.mapInArrow(work, schema)


def _tasks(placed: DataFrame, crowded: DataFrame) -> DataFrame:
    """Each row of ``placed`` in the block pairs (i, j) that need it, on the left (kind 0) or the
    right. A cell's own classes are the first ``own`` blocks, and each pair of these is compared
    once; the classes looked up are the ``looked`` blocks after them, on the right of every own."""
    rows = placed.join(crowded, ["label", "dim", "cell"], "left")
    own, looked = F.coalesce("own", F.lit(1)), F.coalesce("looked", F.lit(0))
    hashed = F.xxhash64("cls")
    first = F.when(F.col("kind") == 0, F.pmod(hashed, own)).otherwise(own + F.pmod(hashed, F.greatest(looked, F.lit(1))))
    rows = rows.withColumns({"x": first.cast("int"), "own": own, "blocks": own + looked})
    number = F.sequence(F.lit(0), F.col("blocks") - 1)
    left = F.transform(
        F.filter(number, lambda j: j >= F.col("x")),
        lambda j: F.struct(F.col("x").alias("i"), j.alias("j"), F.lit(0).alias("kind")),
    )
    right = F.transform(
        F.filter(number, lambda i: (i < F.col("x")) & (i < F.col("own"))),
        lambda i: F.struct(i.alias("i"), F.col("x").alias("j"), F.lit(1).alias("kind")),
    )
    place = F.explode(F.when(F.col("kind") == 0, F.concat(left, right)).otherwise(right)).alias("at")
    return rows.select(*[c for c in placed.columns if c != "kind"], place).select("*", "at.*").drop("at")


def near_vectors(
    vectors: DataFrame,
    *,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    cosine: float = COSINE,
    leaf: int = LEAF,
) -> DataFrame:
    """The id of each row with ``n_links``, ``component_id`` and ``kept``."""
    rows = packed(vectors, id_column, vector_column, label_column)
    double = not isinstance(vectors.schema[vector_column].dataType.elementType, FloatType)
    width = 8 if double else 4
    valid = F.col("vec").isNotNull() & F.col("label").isNotNull()
    rows = rows.withColumns(
        {
            "cls": F.when(valid, F.xxhash64("label", "vec")),
            "dim": (F.length("vec") / width).cast("int"),
        }
    )
    members = stored(rows.select("id", "cls", "label", "dim"), "members")
    rows = rows.where("cls is not null").drop("id")
    classes = (
        members.where("cls is not null")
        .groupBy("cls")
        .agg(
            F.count(F.lit(1)).alias("weight"),
            F.min("id").alias("least"),
            F.first("label").alias("label"),
            F.first("dim").alias("dim"),
        )
    )
    classes = stored(classes, "classes")
    sizes = classes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    cells = F.ceil(F.col("n") / leaf).cast("int").alias("cells")
    large = sizes.where(F.col("n") > leaf).select("label", "dim", cells, F.monotonically_increasing_id().alias("g"))
    large = broadcast_within(stored(large, "large"))
    whole = (
        rows.groupBy("cls")
        .agg(F.first("label").alias("label"), F.first("vec").alias("vec"), F.count(F.lit(1)).alias("weight"))
        .withColumn("dim", (F.length("vec") / width).cast("int"))
    )
    pivots = _pivots(rows, large, leaf, width)
    placed = _placed(whole.join(large, ["label", "dim"], "left"), pivots, cosine, width, ["cls", "weight", "vec"])
    # classes per cell of the large groups, from keys alone
    light = _placed(rows.join(large, ["label", "dim"]), pivots, cosine, width, ["cls"]).distinct()
    counts = light.groupBy("label", "dim", "cell", "kind").agg(F.ceil(F.count(F.lit(1)) / leaf).cast("int").alias("n"))
    crowded = counts.groupBy("label", "dim", "cell").agg(
        F.greatest(F.lit(1), F.max(F.when(F.col("kind") == 0, F.col("n")))).alias("own"),
        F.coalesce(F.max(F.when(F.col("kind") == 1, F.col("n"))), F.lit(0)).alias("looked"),
    )
    crowded = broadcast_within(stored(crowded, "crowded"))
    tasks = _tasks(placed, crowded)

    def compare(table: pa.Table) -> pa.Table:
        return _compare(table, cosine, width)

    found = tasks.groupBy("label", "dim", "cell", "i", "j").applyInArrow(compare, "cls long, n long, root long")
    found = stored(found, "links")
    linked = found.groupBy("cls").agg(F.sum("n").alias("n"))
    labels = components(found.select("cls", "root"))
    of = classes.join(linked, "cls", "left").join(labels, F.col("cls") == F.col("node"), "left")
    of = of.select(
        "cls",
        (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        "least",
        F.coalesce("component", "cls").alias("component"),
    )
    least = of.groupBy("component").agg(F.min("least").alias("first"))
    # stored, so that a class or a component with many rows can be split in the joins
    least = stored(least, "least")
    of = stored(of.join(least, "component").select("cls", "n_links", "first"), "of")
    result = members.select("id", F.col("cls").alias("own")).join(of, F.col("own") == F.col("cls"), "left")
    component = F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.coalesce("first", "id"))
    return result.select(
        F.col("id").alias(id_column),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
