"""Near-duplicate embeddings by an epsilon grid order join.

Two unit vectors have cosine c or more when they are at most eps = sqrt(2 - 2c) apart. The
vectors are rotated to their principal dimensions (any rotation keeps distances; the
principal one makes the leading coordinates the most telling), the leading coordinates
are cut into cells of side eps, and all vectors are sorted by their cells in lexicographic
order: the epsilon grid order, a range exchange in Spark. The sequence is cut into blocks of
about 1 MB. The join starts with the pair (whole sequence, whole sequence) and splits both
intervals into eighths, level by level; a pair of intervals whose bounding boxes in the
leading coordinates are provably more than eps apart is dropped with all below it. Where few
pairs of blocks remain, they are shipped to tasks. Where most remain (vectors without
structure), shipping them would take disk that grows with the square of the table; there the
stored blocks are read by nested loops, file by file, without an exchange, and the boxes of
each pair decide. Tasks go on halving intervals of rows the same way and compare the last
ones by a matrix product in doubles. Vectors are stored and shipped as they came (floats as
floats) and tables of vectors are deleted once the next is written.

A task returns per vector the number of links it found and one edge to a node of its links'
component there - never the links themselves - so a group of n near copies costs n rows a
task at most. Equal vectors are one node with a count. Components follow from the edges.

Defined results: vectors that are null, zero, hold a null or non-finite component, or have
another length than most vectors link with nothing. Repeated rows link as equal vectors do. A
null id counts as a vector but never becomes a component id unless the component has no other.
An empty table gives an empty result. Other columns are not read.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from metroscope.llm.common import drop_written, map_batches, written
from metroscope.llm.components import connected_components

MIN_COSINE = 0.95
GRID_DIMS = 8          # leading principal dimensions in the grid order
BLOCK_BYTES = 1 << 20  # of one block of the sequence
LEAF_ROWS = 128        # intervals of rows that are compared without further halving
FAN_OUT_BITS = 3       # a sequence interval is split in eighths
SHIPPED_PAIRS = 4      # pairs a block that are shipped; beyond, the stored blocks are read in place
FILE_BYTES = 16 << 20  # of one file of blocks: a task of the nested loops holds two
SLACK = 1e-6           # distances are compared with this much room for rounding
CLOSE = 1e-12          # cosines this near to the limit are computed again, vector by vector


def usable_vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id``, ``v`` (floats as they are, else array<double>; null where the vector can link with nothing)."""
    given = rows.select(F.col(vec_col)).schema[0].dataType
    floats = isinstance(given, ArrayType) and isinstance(given.elementType, FloatType)
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    largest = F.array_max(F.transform("v", F.abs))
    src = rows.select(F.col(id_col).alias("id"), F.col(vec_col).cast(f"array<{'float' if floats else 'double'}>").alias("v"))
    return src.select("id", F.when(F.coalesce(finite & (largest > 0), F.lit(False)), F.col("v")).alias("v"))


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """``k1``, ``k2`` (128 hash bits), ``copies``, ``low`` (smallest id), ``v``, ``node``."""
    sizes = vectors.filter("v is not null").groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    dim = sizes.n if sizes else 0
    keyed = vectors.filter(F.size("v") == dim).select(*_keys(), "id", "v")
    folded = keyed.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("low"), F.first("v").alias("v"))
    return written(folded.withColumn("node", F.monotonically_increasing_id()), "ego-vectors")


def _keys() -> list[Column]:
    v = F.col("v").cast("array<double>")
    return [F.xxhash64(v).alias("k1"), F.xxhash64(F.lit(1), v).alias("k2")]


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(col.flatten(), np.float64).reshape(-1, dim)


def unit_rows(m: np.ndarray) -> np.ndarray:
    m = m / np.abs(m).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def principal_axes(folded: DataFrame, dim: int, k: int) -> np.ndarray:
    """The ``k`` leading eigenvectors of the second moments of all unit vectors (dim x k).

    Tasks add up their own dim x dim sums, Spark adds those entry by entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for b in batches:
            if b.num_rows:
                u = unit_rows(_matrix(b.column("v"), dim))
                total += u.T @ u
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim * dim, dtype=np.int32)), pa.array(total.ravel())], ["at", "x"])

    sums = map_batches(folded.select("v"), run, "at int, x double").groupBy("at").agg(F.sum("x").alias("x")).collect()
    moments = np.zeros(dim * dim)
    for r in sums:  # dim x dim numbers
        moments[r["at"]] = r.x
    moments = moments.reshape(dim, dim)
    values, vectors = np.linalg.eigh((moments + moments.T) / 2)
    return vectors[:, np.argsort(-values, kind="stable")[:k]]


def grid_order(folded: DataFrame, dim: int, axes: np.ndarray, eps: float, block_rows: int, total: int) -> DataFrame:
    """The sequence in epsilon grid order: ``at`` (range above 33 bits of place), ``node``, ``copies``, ``v``."""
    k = axes.shape[1]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            p = unit_rows(_matrix(b.column("v"), dim)) @ axes
            cells = np.floor(p / eps).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("node"), b.column("copies"), b.column("v"), *(pa.array(cells[:, i]) for i in range(k)), pa.array(p[:, 0])],
                ["node", "copies", "v", *(f"c{i}" for i in range(k)), "first"])

    cells = ", ".join(f"c{i} int" for i in range(k))
    vector = folded.schema["v"].dataType.simpleString()
    placed = map_batches(folded.select("node", "copies", "v"), project, f"node long, copies long, v {vector}, {cells}, first double")
    order = [*(f"c{i}" for i in range(k)), "first", "node"]
    ranges = max(1, math.ceil(total / (8 * block_rows)))
    spread = placed.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select("node", "copies", "v")
    return written(spread.withColumn("at", F.monotonically_increasing_id()), "ego-order")


def grid_blocks(sequence: DataFrame, dim: int, axes: np.ndarray, block_rows: int, files: int) -> DataFrame:
    """The sequence cut into blocks of ``block_rows``, dealt to ``files`` files: ``block`` (0, 1,
    ... in order), ``nodes``, ``copies``, ``data`` (the vectors), ``low_i``, ``high_i`` (box)."""
    spark, k = sequence.sparkSession, axes.shape[1]
    part = F.shiftright("at", 33)
    counts = {r.part: r.n for r in sequence.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a range
    before, seen = [], 0
    for p in sorted(counts):
        before.append((p, seen))
        seen += counts[p]
    offsets = spark.createDataFrame(before or [(0, 0)], "part long, before long")
    place = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = sequence.withColumn("part", part).join(F.broadcast(offsets), "part").select(place.alias("place"), "node", "copies", "v")
    # blocks of the same size however the ranges fell
    numbered = numbered.withColumn("block", F.floor(F.col("place") / block_rows).cast("long"))
    dealt = numbered.repartitionById(files, (F.col("block") % files).cast("int")).sortWithinPartitions("place")

    def boxed(block: int, rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        nodes, copies = (np.concatenate([r.column(c).to_numpy() for r in rows]) for c in ("node", "copies"))
        raw = np.concatenate([r.column("v").flatten().to_numpy() for r in rows])
        p = unit_rows(raw.astype(np.float64).reshape(-1, dim)) @ axes
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([nodes]), pa.array([copies]), pa.array([raw.tobytes()], pa.binary()),
             *(pa.array([x]) for x in p.min(axis=0)), *(pa.array([x]) for x in p.max(axis=0))],
            ["block", "nodes", "copies", "data", *(f"low_{i}" for i in range(k)), *(f"high_{i}" for i in range(k))])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = -1, []
        for b in batches:
            at = b.column("block").to_numpy()
            cuts = np.flatnonzero(np.diff(at)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(at)]):
                if held and at[start] != block:
                    yield boxed(block, held)
                    held = []
                if end > start:
                    block = int(at[start])
                    held.append(b.slice(start, end - start))
        if held:
            yield boxed(block, held)

    box = ", ".join(f"{s}_{i} double" for s in ("low", "high") for i in range(k))
    gathered = map_batches(dealt.select("block", "node", "copies", "v"), gather, f"block long, nodes array<long>, copies array<long>, data binary, {box}")
    return written(gathered, "ego-blocks")


def _apart(k: int) -> Column:
    """Squared distance of the boxes ``a_low_i``, ``a_high_i`` and ``b_low_i``, ``b_high_i``."""
    gaps = [F.greatest(F.col(f"a_low_{i}") - F.col(f"b_high_{i}"), F.col(f"b_low_{i}") - F.col(f"a_high_{i}"), F.lit(0.0)) for i in range(k)]
    return sum((g * g for g in gaps), F.lit(0.0))


def near_block_pairs(blocks: DataFrame, k: int, n_blocks: int, eps: float) -> DataFrame | None:
    """``a`` <= ``b``: pairs of blocks that can hold vectors at most ``eps`` apart. None where a
    level has more than ``SHIPPED_PAIRS`` of them a block."""
    boxes = blocks.select("block", *(f"{s}_{i}" for s in ("low", "high") for i in range(k)))
    levels = 0
    while n_blocks > 1 << (FAN_OUT_BITS * levels):
        levels += 1
    pairs = boxes.sparkSession.createDataFrame([(0, 0)], "a long, b long")
    for level in range(levels - 1, -1, -1):
        at_level = boxes.groupBy(F.shiftright("block", FAN_OUT_BITS * level).alias("x")).agg(
            *[F.min(f"low_{i}").alias(f"low_{i}") for i in range(k)], *[F.max(f"high_{i}").alias(f"high_{i}") for i in range(k)])
        eighths = F.sequence(F.lit(0), F.lit((1 << FAN_OUT_BITS) - 1))
        child = lambda c, e: F.shiftleft(c, FAN_OUT_BITS) + F.col(e)
        split = pairs.select("a", "b", F.explode(eighths).alias("i")).select("a", "b", "i", F.explode(eighths).alias("j")).select(
            child("a", "i").alias("a"), child("b", "j").alias("b")).filter("a <= b")
        side = lambda name: at_level.select(F.col("x").alias(name), *[F.col(f"{s}_{i}").alias(f"{name}_{s}_{i}") for s in ("low", "high") for i in range(k)])
        met = split.join(side("a"), "a").join(side("b"), "b")
        pairs = written(met.filter(_apart(k) <= (eps + SLACK) ** 2).select("a", "b"), "ego-pairs")
        if pairs.count() > SHIPPED_PAIRS * n_blocks:
            return None
    return pairs


def met_blocks(blocks: DataFrame, pairs: DataFrame | None, k: int, eps: float) -> DataFrame:
    """``a``, ``nodes_a``, ``copies_a``, ``data_a`` and the same of ``b`` (null where ``b`` is ``a``),
    a row for each pair of ``pairs``, or of all blocks whose boxes are near where that is None."""
    boxes = [f"{s}_{i}" for s in ("low", "high") for i in range(k)]
    side = lambda s: blocks.select(F.col("block").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("nodes", "copies", "data")],
                                   *[F.col(c).alias(f"{s}_{c}") for c in boxes])
    same = F.col("a") == F.col("b")
    if pairs is None:  # every file of blocks meets every other one; no exchange, no copy on disk
        met = side("a").join(side("b").hint("shuffle_replicate_nl"), (F.col("a") <= F.col("b")) & (_apart(k) <= (eps + SLACK) ** 2))
    else:
        met = pairs.join(side("a").drop(*[f"a_{c}" for c in boxes]), "a").join(side("b").drop(*[f"b_{c}" for c in boxes]), "b")
    # the left side of a block with itself travels once
    return met.select("a", "nodes_a", "copies_a", "data_a", *[F.when(~same, F.col(c)).alias(c) for c in ("b", "nodes_b", "copies_b", "data_b")])


class _Interval:
    """Rows of a block in sequence order with the boxes of all their halvings."""

    def __init__(self, units: np.ndarray, projected: np.ndarray, start: int, end: int):
        self.start, self.end = start, end
        self.low, self.high = projected[start:end].min(axis=0), projected[start:end].max(axis=0)
        mid = (start + end) // 2
        self.halves = [] if end - start <= LEAF_ROWS else [_Interval(units, projected, start, mid), _Interval(units, projected, mid, end)]

    def apart(self, other: _Interval) -> float:
        gap = np.maximum(np.maximum(self.low - other.high, other.low - self.high), 0.0)
        return float(gap @ gap)


def _leaf_pairs(x: _Interval, y: _Interval, limit: float) -> Iterator[tuple[_Interval, _Interval]]:
    """Pairs of leaves that may hold links; from one interval with itself each pair once."""
    stack = [(x, y)]
    while stack:
        p, q = stack.pop()
        if p.apart(q) > limit:
            continue
        if not p.halves and not q.halves:
            yield p, q
        elif p is q:
            stack += [(p.halves[0], p.halves[0]), (p.halves[0], p.halves[1]), (p.halves[1], p.halves[1])]
        elif q.halves and (not p.halves or q.end - q.start >= p.end - p.start):
            stack += [(p, h) for h in q.halves]
        else:
            stack += [(h, q) for h in p.halves]


def linked(a: np.ndarray, b: np.ndarray, min_cosine: float) -> np.ndarray:
    """Which rows of ``a`` and ``b`` (unit vectors) have cosine ``min_cosine`` or more."""
    cosines = a @ b.T
    out = cosines >= min_cosine
    for i, j in np.argwhere(np.abs(cosines - min_cosine) <= CLOSE):  # the product's order of adding may decide
        out[i, j] = math.fsum(a[i] * b[j]) >= min_cosine
    return out


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)


def block_links(a: np.ndarray, b: np.ndarray | None, copies: np.ndarray, axes: np.ndarray, eps: float,
                min_cosine: float) -> tuple[np.ndarray, list[int]]:
    """Links between the rows of ``a`` and of ``b`` (None: among the rows of ``a``).

    Rows are numbered through ``a`` then ``b``. Returns each row's number of linked vectors
    (copies counted) and its root, the smallest row of its component."""
    n = len(a)
    units = a if b is None else np.concatenate([a, b])
    projected = units @ axes
    x = _Interval(units, projected, 0, n)
    y = x if b is None else _Interval(units, projected, n, len(units))
    counts, forest = np.zeros(len(units), np.int64), _Forest(len(units))
    for p, q in _leaf_pairs(x, y, (eps + SLACK) ** 2):
        hit = linked(units[p.start:p.end], units[q.start:q.end], min_cosine)
        if p is q:
            np.fill_diagonal(hit, False)
        if not hit.any():
            continue
        counts[p.start:p.end] += hit @ copies[q.start:q.end]
        if p is not q:
            counts[q.start:q.end] += copies[p.start:p.end] @ hit
        rows = np.flatnonzero(hit.any(axis=1))
        first = hit.argmax(axis=1)
        top = np.full(hit.shape[1], -1)  # of each column: the first row that links with it
        cols = np.flatnonzero(hit.any(axis=0))
        top[cols] = hit[:, cols].argmax(axis=0)
        for i in rows:
            forest.join(p.start + int(i), q.start + int(first[i]))
        for j in cols:
            forest.join(p.start + int(top[j]), q.start + int(j))
        # rows whose links reach columns of another component: few once the above is joined
        comp_r = np.array([forest.root(p.start + int(i)) for i in rows])
        comp_c = np.array([forest.root(q.start + int(j)) for j in cols])
        for i, j in np.argwhere(hit[np.ix_(rows, cols)] & (comp_r[:, None] != comp_c[None, :])):
            forest.join(p.start + int(rows[i]), q.start + int(cols[j]))
    return counts, [forest.root(i) for i in range(len(units))]


def _pair_results(met: DataFrame, dim: int, floats: bool, axes: np.ndarray, eps: float, min_cosine: float) -> DataFrame:
    """``node``, ``links``, ``root`` (a node) of each vector with links in a task's block pairs."""

    def unpack(b: pa.RecordBatch, s: str, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data = np.frombuffer(b.column(f"data_{s}")[i].as_buffer(), np.float32 if floats else np.float64)
        return (np.asarray(b.column(f"nodes_{s}")[i].values), np.asarray(b.column(f"copies_{s}")[i].values),
                unit_rows(data.astype(np.float64).reshape(-1, dim)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = _Forest(0)
        found: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}  # block: its first row in the forest, nodes, links

        def rows_of(block: int, nodes: np.ndarray, counts: np.ndarray) -> np.ndarray:
            if not counts.any():
                return np.full(len(nodes), -1)
            if block not in found:
                found[block] = len(forest.up), np.array(nodes), np.zeros(len(nodes), np.int64)
                forest.up.extend(range(len(forest.up), len(forest.up) + len(nodes)))
            first, _, links = found[block]
            links += counts
            return first + np.arange(len(nodes))

        for batch in batches:
            for i in range(batch.num_rows):
                nodes, copies, a = unpack(batch, "a", i)
                nodes_b, b = nodes[:0], None
                if batch.column("b")[i].is_valid:
                    nodes_b, copies_b, b = unpack(batch, "b", i)
                    copies = np.concatenate([copies, copies_b])
                counts, roots = block_links(a, b, copies, axes, eps, min_cosine)
                rows = rows_of(batch.column("a")[i].as_py(), nodes, counts[:len(nodes)])
                if b is not None:
                    rows = np.concatenate([rows, rows_of(batch.column("b")[i].as_py(), nodes_b, counts[len(nodes):])])
                for j in np.flatnonzero(counts):
                    if roots[j] != j:
                        forest.join(int(rows[j]), int(rows[roots[j]]))
        names = np.concatenate([np.zeros(0, np.int64), *(nodes for _, nodes, _ in found.values())])
        for first, nodes, links in found.values():
            hit = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[hit]), pa.array(links[hit]), pa.array(names[[forest.root(first + int(j)) for j in hit]])], ["node", "links", "root"])

    return map_batches(met, run, "node long, links long, root long")


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", min_cosine: float = MIN_COSINE,
                    grid_dims: int = GRID_DIMS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``rows``: ``vec_id``, ``n_links``, ``component_id``, ``kept``."""
    if not 0 < min_cosine <= 1:
        raise ValueError("min_cosine must be above 0 and at most 1")
    vectors = written(usable_vectors(rows, id_col, vec_col).select("id", "v", *_keys()), "ego-input")
    folded = distinct_vectors(vectors.drop("k1", "k2"))
    alone = written(vectors.select(F.col("id").alias("vec_id"), "k1", "k2", F.col("v").isNotNull().alias("able")), "ego-ids")
    drop_written(vectors)
    total, dim = folded.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    if not total:
        return alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    distinct = written(folded.select("k1", "k2", "copies", "low", "node"), "ego-distinct")
    floats = isinstance(folded.schema["v"].dataType.elementType, FloatType)
    eps = math.sqrt(2 - 2 * min_cosine)
    eps_cell = max(eps, 1e-3)
    axes = principal_axes(folded, dim, min(grid_dims, dim))
    block_rows = max(256, min(8192, block_bytes // (8 * dim)))
    n_blocks = -(-total // block_rows)
    sequence = grid_order(folded, dim, axes, eps_cell, block_rows, total)
    drop_written(folded)
    # files of blocks: few bytes each, and enough of them that their pairs busy all cores
    busy = min(n_blocks, math.ceil(math.sqrt(4 * rows.sparkSession.sparkContext.defaultParallelism)))
    files = max(busy, math.ceil(total * dim * (4 if floats else 8) / FILE_BYTES))
    blocks = grid_blocks(sequence, dim, axes, block_rows, files)
    drop_written(sequence)
    pairs = near_block_pairs(blocks, axes.shape[1], n_blocks, eps)
    met = met_blocks(blocks, pairs, axes.shape[1], eps)
    found = written(_pair_results(met, dim, floats, axes, eps, min_cosine), "ego-links")
    drop_written(blocks)
    roots = written(connected_components(found.select("node", "root").filter("node != root")), "ego-roots")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    per_node = distinct.join(links, "node", "left").join(roots, "node", "left")
    per_node = written(per_node.withColumn("root", F.coalesce("root", "node")), "ego-nodes")
    lowest = per_node.groupBy("root").agg(F.min("low").alias("component_id"))
    by_key = per_node.join(lowest, "root").select(
        "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), "component_id")
    met = alone.join(by_key, ["k1", "k2"], "left")
    component = F.when(F.col("able"), F.coalesce("component_id", "vec_id")).otherwise(F.col("vec_id"))
    return met.select("vec_id", F.when(F.col("able"), F.coalesce("links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
