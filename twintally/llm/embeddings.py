"""Embedding near-dedup: spherical k-means cells, and blocked cosine products of all pairs that cells do not rule out.

Vectors of length 1 are assigned to the cell of the centroid they are most like. Two vectors of different cells lie on
either side of the border halfway between the centroids, and are at least as far apart as their distances from it come to.
A pair of a cosine of ``threshold`` is ``sqrt(2 - 2 * threshold)`` apart, so pairs whose distances come to more than

- that (``slack="worst"``, the default) cannot be linked. Every pair is found.
- four spreads are left out by ``slack="usual"``, which supposes that the difference of two vectors points evenly in all
  directions: in ``d`` dimensions its part across a border then has a spread of ``1 / sqrt(d - 1)`` of its length.
  Real vectors differ most along the directions that part cells, so this misses pairs.

Equal vectors are one row with a count before that. A cell is cut into blocks of about ``chunk`` rows, written as one row
each; all pairs of blocks come from a product of that table with itself, which reads it again and again but writes and
shuffles nothing, so disk stays in proportion to the input however many pairs there are. The number of products grows
with the square of the rows. They are taken in single precision; what comes too close to the threshold to tell is
compared in double precision. Small cells share a block, as a product costs more to fetch than to take if blocks are small. A comparison gives counts of links and, for what is connected within neither block
already, one row that it is connected with, not the pairs.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twintally.llm.scratch import Scratch, components, quoted, with_least

THRESHOLD = 0.9
CHUNK = 8192
STRIP = 512
ROWS = 1 << 32  # more than a block's rows
MOST_BLOCK = 1 << 24  # bytes of a block's vectors, about
MOST_HELD = 1 << 26  # bytes of blocks that a task keeps for later rows
MOST_FITTED = 32_768

_SPREADS = 4.0


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of an Arrow list column of one length as a matrix of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _units(vectors: np.ndarray) -> np.ndarray:
    """Vectors divided by their lengths; by the largest component first, so that nothing overflows."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def spherical_kmeans(units: np.ndarray, k: int, rounds: int = 8, seed: int = 0) -> np.ndarray:
    """``k`` unit centroids (fewer if there are fewer vectors)."""
    rng = np.random.default_rng(seed)
    centroids = units[np.sort(rng.choice(len(units), min(k, len(units)), replace=False))]
    for _ in range(rounds):
        cell = (units @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, cell, units)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(length > 1e-12, sums / np.maximum(length, 1e-12), centroids)
    return centroids


def half_width(threshold: float, dimensions: int, slack: str) -> float:
    """Half of what the distances of two linked vectors from a border between them may come to."""
    worst = np.sqrt(2 - 2 * threshold) / 2
    if slack == "worst":
        return float(worst) + 1e-9
    across = np.sqrt(1 - threshold * threshold) / np.sqrt(max(dimensions - 1, 1))
    return float(min(worst, _SPREADS / 2 * across)) + 1e-9


def assign(units: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Each vector's cell."""
    return (units @ centroids.T).argmax(axis=1)


def _connected(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each row and column of a matrix of links, the same within what is connected.

    Rows are numbered from 0 and columns on from there; the number is the smallest.
    """
    rows, columns = np.arange(linked.shape[0]), np.arange(linked.shape[1]) + linked.shape[0]
    none = linked.shape[0] + linked.shape[1]
    while True:
        lower = np.minimum(rows, np.where(linked, columns[None, :], none).min(axis=1, initial=none))
        right = np.minimum(columns, np.where(linked, lower[:, None], none).min(axis=0, initial=none))
        if (lower == rows).all() and (right == columns).all():
            return rows, columns
        rows, columns = lower, right


@dataclass
class Block:
    """Some distinct vectors, cell by cell: the rows as they are, of length 1 in single precision, and how many copies each has."""

    cell: np.ndarray
    raw: np.ndarray
    copies: np.ndarray

    def __post_init__(self):
        self.units = _units(self.raw.astype(np.float64)).astype(np.float32)
        starts = np.nonzero(np.diff(self.cell, prepend=-1))[0]
        self.cells = list(zip(self.cell[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(self.cell)]))

    def exact(self, rows: np.ndarray) -> np.ndarray:
        return _units(self.raw[rows].astype(np.float64))


def _linked(x: Block, y: Block, threshold: float, rows: np.ndarray, columns: np.ndarray, within: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of ``x`` and of ``y`` among those given that have links, and which of them are linked.

    ``within``: both are one cell of one block; of a pair only the first way round counts.
    """
    none = rows[:0], columns[:0], np.zeros((0, 0), bool)
    near = _rounding(x.units.shape[1])
    like = x.units[rows] @ y.units[columns].T
    if like.max(initial=-2) < threshold - near:
        return none
    linked = like >= threshold - near
    if within:
        linked &= columns[None, :] > rows[:, None]
    left, right = np.nonzero(linked.any(axis=1))[0], np.nonzero(linked.any(axis=0))[0]
    linked = linked[np.ix_(left, right)]
    a, b = np.nonzero(linked & (like[np.ix_(left, right)] < threshold + near))
    for start in range(0, len(a), 4096):
        i, j = a[start : start + 4096], b[start : start + 4096]
        linked[i, j] = np.einsum("nd,nd->n", x.exact(rows[left[i]]), y.exact(columns[right[j]])) >= threshold
    return rows[left], columns[right], linked


def _rounding(dimensions: int) -> float:
    """More than what a product of two vectors of length 1 in single precision may be off."""
    return (dimensions + 8) * 2.0**-23


def _pairs(x: Block, y: Block, threshold: float, width: float, centroids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """What :func:`_linked` finds, strip by strip, of two blocks or of one with itself."""
    for cell, start, stop in x.cells:
        for other, begin, end in y.cells:
            if x is y and begin < start:
                continue
            within = x is y and begin == start
            rows, columns = np.arange(start, stop), np.arange(begin, end)
            apart = centroids[cell] - centroids[other]
            length = np.linalg.norm(apart)
            reach = np.full(len(rows), len(columns))
            if length > 1e-6:
                # Distances from the border, the nearest first.
                across = (apart / length).astype(np.float32)
                of_x, of_y = x.units[start:stop] @ across, -(y.units[begin:end] @ across)
                by_x, by_y = np.argsort(of_x), np.argsort(of_y)
                reach = np.searchsorted(of_y[by_y], width - of_x[by_x] + 4 * _rounding(len(across)), "right")
                rows, columns = rows[by_x], columns[by_y]
            for at in range(0, len(rows), STRIP):
                if not reach[at]:
                    break
                some = rows[at : at + STRIP]
                for first in range(at if within else 0, reach[at], 8 * STRIP):
                    found = _linked(x, y, threshold, some, columns[first : min(first + 8 * STRIP, reach[at])], within)
                    if len(found[0]):
                        yield found


def _within(block: Block, threshold: float, width: float, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many links each row of a block has to copies of others in it, and the first row that they connect it with."""
    n = np.zeros(len(block.units), np.int64)
    ends: list[np.ndarray] = [np.zeros((2, 0), np.int64)]
    for left, right, linked in _pairs(block, block, threshold, width, centroids):
        n[left] += linked @ block.copies[right]
        n[right] += block.copies[left] @ linked
        both, own = np.append(left, right), np.concatenate(_connected(linked))
        ends.append(np.stack([both, both[own]]))
    root = np.arange(len(n))
    a, b = np.concatenate(ends, axis=1)
    while True:
        lower = root.copy()
        np.minimum.at(lower, a, root[b])
        np.minimum.at(lower, b, root[a])
        lower = lower[lower]
        if (lower == root).all():
            return n, root
        root = lower


def _between(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of rows and columns as pairs of their roots that connect what is connected."""
    for axis, roots in enumerate((left, right)):
        order = np.argsort(roots, kind="stable")
        starts = np.nonzero(np.diff(roots[order], prepend=-1))[0]
        linked = np.logical_or.reduceat(linked.take(order, axis=axis), starts, axis=axis)
    left, right = np.unique(left), np.unique(right)
    rows, columns = _connected(linked)
    ends = np.append(left, -1 - right)  # a column's root by a negative number
    root = np.append(rows, columns)
    joined = np.nonzero(root != np.arange(len(root)))[0]
    return ends[joined], ends[root[joined]]


def _found(a: np.ndarray, b: np.ndarray | None, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.nulls(len(a), pa.int64()) if b is None else pa.array(b), pa.array(n)], ["a", "b", "n"])


def _compare(threshold: float, width: float, dimensions: int, kind: str, shared):
    """Compares two blocks a row; counts of links are added up over all rows of a task."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: OrderedDict[int, tuple[Block, np.ndarray]] = OrderedDict()
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                sides = []
                for side in "xy":
                    number, cell, raw, copies, root = (batch.column(f"{side}_{c}")[row] for c in ("block", "cell", "raw", "copies", "root"))
                    number = number.as_py()
                    if number not in held:
                        matrix = np.frombuffer(raw.as_buffer(), kind).reshape(-1, dimensions).copy()
                        held[number] = Block(cell.values.to_numpy(), matrix, copies.values.to_numpy().copy()), root.values.to_numpy().astype(np.int64)
                    held.move_to_end(number)
                    sides.append((number, *held[number]))
                while len(held) > 2 and sum(b.raw.nbytes + b.units.nbytes for b, _ in held.values()) > MOST_HELD:
                    held.popitem(last=False)
                (at_x, x, root_x), (at_y, y, root_y) = sides
                for at, block in ((at_x, x), (at_y, y)):
                    counts.setdefault(at, np.zeros(len(block.copies), np.int64))
                for left, right, linked in _pairs(x, y, threshold, width, shared.value):
                    counts[at_x][left] += linked @ y.copies[right]
                    counts[at_y][right] += x.copies[left] @ linked
                    a, b = (np.where(e < 0, at_y * ROWS - 1 - e, at_x * ROWS + e) for e in _between(linked, root_x[left], root_y[right]))
                    yield _found(a, b, np.zeros(len(a), np.int64))
        for at, n in counts.items():
            some = np.nonzero(n)[0]
            yield _found(at * ROWS + some, None, n[some])

    return compare


def near_vectors(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    threshold: float = THRESHOLD,
    slack: str = "worst",
    chunk: int = CHUNK,
    most_fitted: int = MOST_FITTED,
) -> DataFrame:
    """One row per input row: ``vec_id, n_links, component_id, kept``.

    ``n_links`` counts the other rows whose cosine with this one, in double precision, is at least
    ``threshold``; ``component_id`` is the smallest identifier that links reach, the row's own included;
    ``kept`` says that they are the same. Centroids are fitted on at most ``most_fitted`` distinct
    vectors, chosen by hash; every vector is assigned and compared.

    - Vectors that are null, empty or zero, or that hold null, NaN or infinite components, link with
      nothing. Vectors of different lengths are never linked: each length is handled by itself.
    - A null identifier is never the smallest; rows without one are kept only if their component has none.
    - Rows that repeat an identifier are rows of their own, linked like any others.
    - An empty table gives no rows. Other columns, labels among them, are not read.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "embeddings", clean=True)
    given = vectors.select(quoted(vector_column)).schema[0].dataType
    kind = "float" if isinstance(given, T.ArrayType) and isinstance(given.elementType, T.FloatType) else "double"
    raw = quoted(vector_column).cast(f"array<{kind}>")
    rows = vectors.select(quoted(id_column).cast("long").alias("vec_id"), raw.alias("raw"))
    usable = F.coalesce(
        F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("raw", lambda x: x != 0),
        F.lit(False),
    )
    # Adding 0 makes -0.0 and 0.0 the same value.
    key = F.when(usable, F.transform("raw", lambda x: x + F.lit(0.0).cast(kind)))
    rows = rows.select("vec_id", key.alias("vector"))
    digest = F.unhex(F.sha2(F.col("vector").cast("string"), 256))
    # About how many different vectors there are of each length; no more than the cells are chosen by it.
    about = rows.where("vector is not null").groupBy(F.size("vector")).agg(F.approx_count_distinct(F.xxhash64("vector")))
    sizes = {size: max(1, n) for size, n in about.collect()}
    own = F.col("vec_id").alias("component_id")
    if not sizes:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), own, F.lit(True).alias("kept"))
    heads, found, begun = [], [], 0
    for size, total in sorted(sizes.items()):
        some = rows.where(F.size("vector") == size).withColumn("digest", digest)
        blocks, compared, begun = _compare_all(some, scratch, size, total, kind, begun, threshold, slack, chunk, most_fitted)
        each = F.posexplode(F.arrays_zip("digest", "first", "copies", "n", "root")).alias("place", "at")
        each = blocks.select("block", each).select((F.col("block") * ROWS + F.col("place")).alias("rep"), (F.col("block") * ROWS + F.col("at.root")).alias("near"), "at.*")
        heads.append(scratch.keep(each.drop("root"), f"heads-{size}"))
        scratch.drop(f"blocks-{size}")
        found.append(compared)
    numbered, results = (reduce(DataFrame.unionAll, frames) for frames in (heads, found))
    edges = results.where("b is not null").select("a", "b")
    edges = edges.unionAll(numbered.where("rep <> near").select(F.col("rep").alias("a"), F.col("near").alias("b")))
    roots = components(edges, scratch)
    counts = results.where("b is null").groupBy("a").agg(F.sum("n").alias("more"))
    joined = (
        numbered.join(counts, numbered["rep"] == counts["a"], "left")
        .join(roots, numbered["rep"] == roots["node"], "left")
        .select("digest", "first", "rep", (F.coalesce("more", F.lit(0)) + F.col("n") + F.col("copies") - 1).alias("n_links"), "root")
    )
    groups = with_least(joined, "rep", "first", "component_id").select("digest", "n_links", "component_id")
    groups = scratch.keep(groups, "groups")
    scratch.drop(*[f"{name}-{size}" for size in sizes for name in ("heads", "compared")])
    linked = rows.select("vec_id", digest.alias("digest")).join(groups, "digest", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
    return linked.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _compare_all(
    rows: DataFrame, scratch: Scratch, size: int, total: int, kind: str, begun: int, threshold: float, slack: str, chunk: int, most_fitted: int
) -> tuple[DataFrame, DataFrame, int]:
    """The written blocks of the distinct vectors of one length, about ``total``, numbered from ``begun``; ``a, b, n``: counts of
    links (b null) and connecting links between blocks; and the next block's number."""
    spark = rows.sparkSession
    share = min(1.0, 1.1 * most_fitted / total + 100 / total)
    picked = rows.where(F.xxhash64(F.lit("fit"), "vector") / float(2**64) + 0.5 <= share).select("digest", "vector").distinct()
    fitted = _units(_matrix(picked.orderBy("digest").limit(most_fitted).toArrow()["vector"]))
    cells = max(1, int(np.ceil(np.sqrt(total) / 4)))
    centroids = spherical_kmeans(fitted, min(cells, max(1, most_fitted // 16)))
    # A cell's share of what it was fitted on tells its blocks; small ones share a block.
    shares = np.bincount(assign(fitted, centroids), minlength=len(centroids)) / len(fitted)
    chunk = max(1, min(chunk, MOST_BLOCK // (size * (4 if kind == "float" else 8))))
    parts = np.maximum(1, np.ceil(shares * total / chunk)).astype(np.int64)
    firsts, room = np.empty(len(parts), np.int64), -1.0
    for cell, n in enumerate(shares * total):
        if parts[cell] > 1 or n > room:
            firsts[cell], room = begun, chunk - n
            begun += int(parts[cell])
        else:
            firsts[cell], room = begun - 1, room - n
    shared = spark.sparkContext.broadcast(centroids)
    width = 2 * half_width(threshold, size, slack)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(at, 1000) for at in range(0, batch.num_rows, 1000)):
                cell = assign(_units(_matrix(part.column("vector"))).astype(np.float32), shared.value.astype(np.float32))
                mixed = np.frombuffer(b"".join(part.column("digest").to_pylist()), "<u8")[::4]
                number = firsts[cell] + (mixed % parts[cell].astype(np.uint64)).astype(np.int64)
                columns = [pa.array(number), pa.array(cell.astype(np.int32)), *part.columns]
                yield pa.RecordBatch.from_arrays(columns, ["block", "cell", *part.schema.names])

    def pack(key: tuple, some: pa.Table) -> pa.Table:
        some = some.sort_by([("cell", "ascending"), ("digest", "ascending")])
        vectors = some["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
        block = Block(some["cell"].to_numpy(), vectors, some["copies"].to_numpy())
        n, root = _within(block, threshold, width, shared.value)
        lists = [some["cell"], some["digest"], some["first"], some["copies"], pa.array(n), pa.array(root.astype(np.int32))]
        whole = [pa.ListArray.from_arrays([0, len(n)], x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x) for x in lists]
        values = [pa.array([key[0].as_py()], pa.int64()), pa.array([vectors.tobytes()], pa.binary()), *whole]
        return pa.Table.from_arrays(values, ["block", "raw", "cell", "digest", "first", "copies", "n", "root"])

    distinct = rows.groupBy("digest").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
    schema = f"block long, cell int, digest binary, first long, copies long, vector array<{kind}>"
    blocks = distinct.mapInArrow(place, schema).groupBy("block").applyInArrow(
        pack, "block long, raw binary, cell array<int>, digest array<binary>, first array<long>, copies array<long>, n array<long>, root array<int>"
    )
    blocks = scratch.keep(blocks, f"blocks-{size}")
    x, y = (blocks.select(*[F.col(c).alias(f"{side}_{c}") for c in ("block", "cell", "raw", "copies", "root")]) for side in "xy")
    met = x.join(y, F.col("x_block") < F.col("y_block"))
    compared = met.mapInArrow(_compare(threshold, width, size, "<f4" if kind == "float" else "<f8", shared), "a long, b long, n long")
    return blocks, scratch.keep(compared, f"compared-{size}"), begun
