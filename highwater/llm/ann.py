"""Operator 10: nearest neighbours by low-dimensional stable projections under a kd-tree.

Unit vectors are projected onto DIMENSIONS Gaussian directions: for a pair at distance d, the squared distance
of the projections over d squared follows a chi-square law with DIMENSIONS degrees of freedom. So with
the k-th best distance d found so far, a point whose projection lies beyond d * sqrt(quantile) is
nearer than d only with a chance of 1 - CONFIDENCE: leaves of a kd-tree over the projections are taken
in the order of their distance, their points are verified on the whole vectors, and the search stops
at the first leaf beyond that radius.

The tree's upper part is cut from a bounded sample (SAMPLE projections) into cells, one or more per task.
A query is first answered in its own cell. Then it goes on in rounds, to the nearest cells that it has not seen, in the
first round to STEP of them and in each further one to GROWTH times as many; after each round the distance found so far
tightens its test, and a query that no cell passes leaves. The queries that go to a cell travel packed. Every vector is in
the index; vectors of different width, which have no cosine, are indexes of their own.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from highwater.functions.lineage import materialise
from highwater.functions.skew import split_join
from highwater.llm.common import partitions, ship

DIMENSIONS = 12
CONFIDENCE = 0.98
K = 5
EVERY = 50
SAMPLE = 20_000
CELL = 4096  # vectors per cell, about
LEAF = 256
BLOCK = 1024  # queries that meet a cell together
STEP, GROWTH = 4, 4
MAX_DEPTH = 16  # so 65,536 cells at most, larger ones beyond that


def chi_square_quantile(p: float, k: int) -> float:
    """By bisection over the regularised lower gamma function."""

    def below(x):
        term = total = 1 / (k / 2)
        n = k / 2
        while term > total * 1e-14:
            n += 1
            term *= x / 2 / n
            total += term
        return total * math.exp(-x / 2 + k / 2 * math.log(x / 2) - math.lgamma(k / 2))

    low, high = 1e-9, 10.0 * k + 100
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < p else (low, middle)
    return high


def directions(width: int, m: int = DIMENSIONS) -> np.ndarray:
    return np.random.default_rng(10).standard_normal((width, m))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.sqrt((x * x).sum(axis=-1, keepdims=True))
    return x / norm


def _prepare(batches):
    """(vec_id, width, vec) of the vectors that take part: finite, not null and not zero."""
    for batch in batches:
        ids, widths, vectors = [], [], []
        for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if i is None or not v or any(x is None for x in v):
                continue
            x = np.array(v, np.float64)
            top = np.abs(x).max()
            if not np.isfinite(top) or top == 0:
                continue
            ids.append(i)
            widths.append(len(x))
            vectors.append(x.tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(widths, pa.int32()), pa.array(vectors, pa.binary())],
            ["vec_id", "width", "vec"],
        )


def _project(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(axis=1, keepdims=True)  # so that no square overflows
    return _unit(scaled) @ directions(x.shape[1])


class Splits:
    """The upper part of the tree: medians of a sample, in the direction that a node spreads most in."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth, self.cuts, self.axes = depth, np.zeros(2**depth), np.zeros(2**depth, np.int64)
        self._cut(sample, 1, 0)

    def _cut(self, sample, node, level):
        if level == self.depth:
            return
        axis = int(sample.std(axis=0).argmax()) if len(sample) else level % DIMENSIONS
        self.axes[node] = axis
        self.cuts[node] = np.median(sample[:, axis]) if len(sample) else 0.0
        right = sample[:, axis] > self.cuts[node]
        self._cut(sample[~right], 2 * node, level + 1)
        self._cut(sample[right], 2 * node + 1, level + 1)

    def cell(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), np.int64)
        for _ in range(self.depth):
            node = 2 * node + (points[np.arange(len(points)), self.axes[node]] > self.cuts[node])
        return node - 2**self.depth


class Boxes:
    """What the vectors of each cell span in every direction."""

    def __init__(self, cells: int):
        self.low, self.high = np.full((cells, DIMENSIONS), np.inf), np.full((cells, DIMENSIONS), -np.inf)

    def within(self, point: np.ndarray, radius: float) -> np.ndarray:
        """Cells whose box comes within ``radius`` of ``point``, the nearest first."""
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        away = (gap * gap).sum(axis=1)
        near = np.flatnonzero(away <= radius * radius)
        return near[np.argsort(away[near], kind="stable")]


class Tree:
    """A kd-tree over the projections of a cell: leaves with their boxes."""

    def __init__(self, points: np.ndarray):
        parts = [np.arange(len(points))]
        while max(map(len, parts)) > LEAF:
            split = []
            for part in parts:
                if len(part) <= LEAF:
                    split.append(part)
                    continue
                axis = np.argmax(points[part].max(axis=0) - points[part].min(axis=0))
                order = part[np.argsort(points[part, axis], kind="stable")]
                split += [order[: len(order) // 2], order[len(order) // 2 :]]
            parts = split
        self.leaves = parts
        self.low = np.stack([points[p].min(axis=0) for p in parts])
        self.high = np.stack([points[p].max(axis=0) for p in parts])

    def order(self, point: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaves by the distance of their boxes, and these squared distances."""
        gap = np.maximum(np.maximum(self.low - point, point - self.high), 0)
        away = (gap * gap).sum(axis=1)
        order = np.argsort(away, kind="stable")
        return order, away[order]


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of one vector and many, in double precision, summed the same way wherever it is done."""
    top_a, top_b = np.abs(a).max(), np.abs(b).max(axis=1, keepdims=True)
    a, b = a / top_a, b / top_b
    return (b * a).sum(axis=1) / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum(axis=1)))


def nearest(tree, vectors, ids, query, projected, own_id, k, limit, bound=math.inf):
    """The k best (id, score) of a cell for a query, until the chi-square test stops the search.

    ``bound``: a squared distance that k others are already known to have.
    """
    best_ids, best = np.empty(0, np.int64), np.empty(0)
    order, away = tree.order(projected)
    for leaf, gap in zip(order, away, strict=True):
        if gap > limit * bound:
            break
        rows = tree.leaves[leaf]
        rows = rows[ids[rows] != own_id]
        best_ids = np.concatenate([best_ids, ids[rows]])
        best = np.concatenate([best, cosine(query, vectors[rows])])
        top = np.lexsort((best_ids, -best))[:k]
        best_ids, best = best_ids[top], best[top]
        if len(best) == k:
            bound = min(bound, max(0.0, 2 - 2 * best[-1]))
    return best_ids, best


def _by_width(batch):
    """(width, rows, vectors) for every width of a batch with the columns width and vec."""
    widths = batch.column(batch.schema.get_field_index("width")).to_numpy(zero_copy_only=False)
    column = batch.column(batch.schema.get_field_index("vec"))
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        yield int(width), rows, _matrix(column.take(pa.array(rows)))


def _cells(splits):
    """(vec_id, width, vec, cell) of (vec_id, width, vec)."""

    def run(batches):
        for batch in batches:
            cells = np.zeros(batch.num_rows, np.int64)
            for width, rows, vectors in _by_width(batch):
                cells[rows] = splits.value[width].cell(_project(vectors))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells)], ["vec_id", "width", "vec", "cell"])

    return run


def _spans(batches):
    """(width, cell, axis, low, high) of what the cells of a batch span."""
    for batch in batches:
        rows = ([], [], [], [], [])
        cells = batch.column(3).to_numpy()
        for width, at, vectors in _by_width(batch):
            points = _project(vectors)
            order = np.argsort(cells[at], kind="stable")
            firsts = np.flatnonzero(np.diff(cells[at][order], prepend=-1))
            low = np.minimum.reduceat(points[order], firsts)
            high = np.maximum.reduceat(points[order], firsts)
            there = cells[at][order][firsts]
            rows[0].extend([width] * low.size)
            rows[1].extend(np.repeat(there, DIMENSIONS))
            rows[2].extend(np.tile(np.arange(DIMENSIONS), len(there)))
            rows[3].extend(low.ravel())
            rows[4].extend(high.ravel())
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(rows, kinds, strict=True)], ["width", "cell", "axis", "low", "high"]
        )


def boxes_of(cells: DataFrame, index: dict[int, Splits]) -> dict[int, Boxes]:
    """The boxes of all cells of each width: DIMENSIONS rows a cell, of 2 ** MAX_DEPTH cells at most."""
    out = {width: Boxes(2**splits.depth) for width, splits in index.items()}
    spans = cells.mapInArrow(_spans, "width int, cell bigint, axis int, low double, high double")
    spans = spans.groupBy("width", "cell", "axis").agg(F.min("low").alias("low"), F.max("high").alias("high")).toArrow()
    width, cell, axis, low, high = (spans[c].to_numpy() for c in ("width", "cell", "axis", "low", "high"))
    for w, boxes in out.items():
        mine = width == w
        boxes.low[cell[mine], axis[mine]], boxes.high[cell[mine], axis[mine]] = low[mine], high[mine]
    return out


_PACKED = "width int, cell bigint, n int, ids binary, vecs binary, bounds binary"


def _visits(boxes, limit: float, seen: int | None, step: int):
    """Packed queries for the cells that they visit now. Columns: vec_id, width, vec, cell, bound.

    Without ``seen`` that is the own cell, otherwise the next ``step`` of all others after the first ``seen``.
    """

    def run(batches):
        for batch in batches:
            packed = []
            ids, own, bounds = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 3, 4))
            for width, rows, vectors in _by_width(batch):
                if seen is None:
                    queries, cells = np.arange(len(rows)), own[rows]
                else:
                    points, there = _project(vectors), []
                    for i, r in enumerate(rows):
                        near = boxes.value[width].within(points[i], math.sqrt(limit * bounds[r]) + 1e-9)
                        there.append(near[near != own[r]][seen : seen + step])
                    queries = np.repeat(np.arange(len(rows)), [len(t) for t in there])
                    cells = np.concatenate(there).astype(np.int64)
                for cell in np.unique(cells):
                    mine = queries[cells == cell]
                    for at in range(0, len(mine), BLOCK):
                        some = mine[at : at + BLOCK]
                        of = rows[some]
                        packed.append(
                            (width, cell, len(some), ids[of].tobytes(), vectors[some].tobytes(), bounds[of].tobytes())
                        )
            columns = list(zip(*packed, strict=True)) or [()] * 6
            kinds = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                ["width", "cell", "n", "ids", "vecs", "bounds"],
            )

    return run


def _answer(k: int, limit: float):
    """A part of a cell and packed queries: the best of the part for each query."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = ([], [], [])
        if left.num_rows and right.num_rows:
            vectors, ids = _matrix(left["vec"]), left["vec_id"].to_numpy()
            tree = Tree(_project(vectors))
            for names, vecs, bounds in zip(*(right[c].to_pylist() for c in ("ids", "vecs", "bounds")), strict=True):
                names, bounds = np.frombuffer(names, np.int64), np.frombuffer(bounds, np.float64)
                queries = np.frombuffer(vecs, np.float64).reshape(len(names), -1)
                projected = _project(queries)
                for i, id_ in enumerate(names):
                    found, scores = nearest(tree, vectors, ids, queries[i], projected[i], id_, k, limit, bounds[i])
                    out[0].extend([id_] * len(found))
                    out[1].extend(found)
                    out[2].extend(scores)
        return pa.table(
            {"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())}
        )

    return run


def _meet(cells: DataFrame, visits: DataFrame, k: int, limit: float) -> DataFrame:
    """Answers of each cell, cells and packed queries dealt in blocks: a cell of more than 2 * CELL vectors is
    searched in parts, and about BLOCK queries, 2 * BLOCK at most from one row, meet a part in one task."""
    own = ["width", "cell"]
    sizes = cells.groupBy(*own).agg(F.ceil(F.count(F.lit(1)) / (2 * CELL)).cast("int").alias("parts"))
    asks = visits.groupBy(*own).agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks"))
    grid = sizes.join(asks, own)

    def dealt(df, name, mine, other):
        placed = split_join(df, grid, own, "inner")
        number = F.pmod(F.xxhash64(name, F.lit(mine)), F.col(mine)).cast("int").alias(mine[:-1])
        return placed.select(*df.columns, number, F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other[:-1]))

    keys = (*own, "part", "block")
    left = dealt(cells, "vec_id", "parts", "blocks").groupBy(*keys)
    right = dealt(visits, "ids", "blocks", "parts").groupBy(*keys)
    return left.cogroup(right).applyInArrow(_answer(k, limit), "query_id bigint, vec_id bigint, score double")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest_neighbours(
    vectors: DataFrame, k: int = K, every: int = EVERY, confidence: float = CONFIDENCE
) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest found of every query by cosine.

    ``vectors`` has vec_id and embedding; queries are the rows whose vec_id is divisible by ``every``.
    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do
    vectors without an id. A vector is compared with those of its own width only. Equal scores go by the smaller
    vec_id; of rows with the same vec_id one is kept, the one with the smallest bytes. Extra columns are not read;
    without vectors there are no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    columns = "vec_id bigint, width int, vec binary"
    clean = vectors.select(F.col("vec_id").cast("long"), "embedding").mapInArrow(_prepare, columns)
    clean = clean.groupBy("vec_id").agg(F.min(F.struct("vec", "width")).alias("v"))
    clean = materialise(clean.select("vec_id", "v.width", "v.vec"), "vectors")
    counts = {r.width: r["count"] for r in clean.groupBy("width").count().collect()}  # a row per width
    n = sum(counts.values())
    share = SAMPLE * (1 << 20) / max(1, n)
    drawn = clean.where(F.pmod(F.xxhash64("vec_id", F.lit(4)), F.lit(1 << 20)) < share).select("width", "vec").toArrow()
    found = {width: _project(x) for batch in drawn.combine_chunks().to_batches() for width, _, x in _by_width(batch)}
    index = {}
    for width, m in counts.items():
        depth = min(MAX_DEPTH, max(0, math.ceil(math.log2(m / CELL))))
        index[width] = Splits(found.get(width, np.empty((0, DIMENSIONS))), depth)
    splits = spark.sparkContext.broadcast(index)  # 2 ** MAX_DEPTH cuts a width at most
    limit = chi_square_quantile(confidence, DIMENSIONS)
    cells = materialise(clean.mapInArrow(_cells(splits), f"{columns}, cell bigint"), "cells")
    boxes = spark.sparkContext.broadcast(boxes_of(cells, index))
    # Columns of their own, since queries meet the rows they were taken from.
    queries = cells.where(F.col("vec_id") % every == 0).select(*[F.col(c).alias(c) for c in cells.columns])
    n_tasks = partitions(spark)
    visits = queries.withColumn("bound", F.lit(4.0)).mapInArrow(_visits(boxes, limit, None, 0), _PACKED)
    best = materialise(_best(_meet(cells, materialise(visits, "visits"), k, limit), k).drop("rank"), "best")
    seen, step, most = 0, STEP, max((2**i.depth for i in index.values()), default=0) - 1
    while seen < most:
        bound = F.when(F.col("n") >= k, F.greatest(2 - 2 * F.col("worst"), F.lit(0.0))).otherwise(4.0)
        counted = best.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("worst"))
        known = queries.join(counted, F.col("vec_id") == F.col("query_id"), "left")
        known = known.select(*queries.columns, F.coalesce(bound, F.lit(4.0)).alias("bound"))
        onward = known.repartition(n_tasks, "vec_id").mapInArrow(_visits(boxes, limit, seen, step), _PACKED)
        onward = materialise(onward, "visits")
        if onward.isEmpty():
            break
        best = materialise(_best(best.unionByName(_meet(cells, onward, k, limit)), k).drop("rank"), "best")
        seen, step = seen + step, step * GROWTH
    return _best(best, k).select("query_id", "rank", "vec_id", "score")
