"""Operator 12: hard negatives from a cover tree over norm-augmented candidates.

Every vector x gets one more component, the root of M * M - |x| * |x| with M the largest norm, so that all lie on one
sphere and the inner product with an anchor falls with the distance to it. Over these points stands a cover tree: the
children of a node are picked farthest first, starting with its own centre, so that on each level the centres are as far
apart as their node's points are from them; each node knows its covering radius. With it, the triangle inequality on
the sphere and the Cauchy-Schwarz inequality bound the inner products of a whole node from both sides.

A search goes from the root by the best upper bound first. It leaves out nodes that lie outside all of its windows, or
below the k-th best that a window already has, and takes the exact products of the leaves that remain. Positives are the
search with one open window, among rows of the same label; negatives that with a window per positive, among the others.

The tree's top level is made of centres of a bounded sample (SAMPLE rows); below each centre, the points of its cell are
cut into parts of PART_BYTES, each with a tree of its own in one task. Anchors stream past a part's tree, after the
top level's bounds told them which cells to visit; the own cell comes first for the positives.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from highwater.functions.lineage import materialise
from highwater.functions.skew import split_join
from highwater.llm.common import partitions, ship

EVERY = 100
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90  # percent of the positive's score
SCALE = 256
SAMPLE = 8192  # rows, over all widths
CELL = 4096  # rows of a cell, about, as long as there are no more than CELLS
CELLS = 1024
PART_BYTES = 32 << 20
BLOCK = 1 << 16  # anchors that pass a part in one task
FANOUT = 16
LEAF = 512
LEAST, MOST = -(2**63), 2**63 - 1


def norms(vectors: np.ndarray) -> np.ndarray:
    """Euclidean norms; infinite where squares are."""
    with np.errstate(over="ignore"):
        return np.linalg.norm(vectors, axis=-1)


def _prepare(batches):
    """(vec_id, label, width, norm, vec) of rows that take part, components scaled and rounded down."""
    for batch in batches:
        out = ([], [], [], [], [])
        for i, label, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if i is None or label is None or v is None or any(x is None for x in v):
                continue
            with np.errstate(over="ignore", invalid="ignore"):
                x = np.floor(SCALE * np.array(v, np.float64)) + 0.0  # no negative zero
            if not np.isfinite(x).all():
                continue
            for column, value in zip(out, (i, label, len(x), float(norms(x)), x.tobytes()), strict=True):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.binary())
        arrays = [pa.array(c, kind) for c, kind in zip(out, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "label", "width", "norm", "vec"])


def matrix(column, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(len(column), width)


def products(vectors: np.ndarray, query: np.ndarray, largest: float) -> np.ndarray:
    """Exact inner products of whole numbers up to ``largest``; beyond 64 bits the nearest long."""
    with np.errstate(over="ignore"):
        if len(query) * largest * np.abs(query).max(initial=0) < 2.0**53:
            return (vectors @ query).astype(np.int64)
    q = [int(x) for x in query]
    exact = [sum(int(a) * b for a, b in zip(v, q, strict=True)) for v in vectors]
    return np.array([min(max(x, LEAST), MOST) for x in exact], np.int64)


def augmented(vectors: np.ndarray, largest: float) -> np.ndarray:
    """Points on a sphere around zero: vectors with one more component, scaled to the largest norm. Without a
    finite one they are all the same, and nothing is told apart by bounds."""
    if not largest or not np.isfinite(largest):
        return np.zeros((len(vectors), vectors.shape[1] + 1))
    unit = vectors / largest
    more = np.sqrt(np.maximum(0, 1 - (unit * unit).sum(axis=1)))
    return np.concatenate([unit, more[:, None]], axis=1)


def bounds(cosines: np.ndarray, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest inner product of a unit query with points within ``radius`` of centres on the unit
    sphere, given its inner products with the centres; some more for what rounding takes."""
    away = np.sqrt(np.maximum(0, 2 - 2 * cosines))
    low = np.maximum(cosines - radius, 1 - (away + radius) ** 2 / 2)
    high = np.minimum(cosines + radius, 1 - np.maximum(0, away - radius) ** 2 / 2)
    return low - 1e-9, high + 1e-9


def farthest_first(points: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Up to k centres, the first point first; for every point its centre's number and the distance to it."""
    picked, of = [0], np.zeros(len(points), np.int64)
    away = ((points - points[0]) ** 2).sum(axis=1)
    while len(picked) < k:
        far = int(away.argmax())
        if away[far] <= 0:
            break
        closer = ((points - points[far]) ** 2).sum(axis=1)
        of[closer < away] = len(picked)
        away = np.minimum(away, closer)
        picked.append(far)
    return np.array(picked), of, np.sqrt(away)


class CoverTree:
    """Nodes with a centre, a covering radius and either children or the rows of a leaf, which lie side by side."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        self.top = float(np.abs(vectors).max(initial=0))
        self.largest = float(norms(vectors).max())
        points = augmented(vectors, self.largest)
        self.centres, self.radius, self.children, self.rows = [points[0]], [2.0], [None], [np.arange(len(vectors))]
        open_ = [0]
        while open_:
            node = open_.pop()
            rows = self.rows[node]
            if len(rows) <= LEAF:
                continue
            picked, of, away = farthest_first(points[rows], FANOUT)
            if len(picked) == 1:  # all equal
                continue
            first = len(self.centres)
            for k in range(len(picked)):
                mine = of == k
                self.centres.append(points[rows[picked[k]]])
                self.radius.append(float(away[mine].max()))
                self.children.append(None)
                # The centre stays first: it is the first child's centre as well.
                self.rows.append(np.concatenate([[rows[picked[k]]], rows[mine & (np.arange(len(rows)) != picked[k])]]))
            self.children[node], self.rows[node] = slice(first, len(self.centres)), None
            open_ += range(first, len(self.centres))
        self.centres, self.radius = np.array(self.centres), np.array(self.radius)
        leaves = [n for n, rows in enumerate(self.rows) if rows is not None]
        order = np.concatenate([self.rows[n] for n in leaves])
        self.vectors, self.ids, self.labels = vectors[order], ids[order], labels[order]
        ends = np.cumsum([len(self.rows[n]) for n in leaves])
        for n, end in zip(leaves, ends, strict=True):
            self.rows[n] = slice(int(end) - len(self.rows[n]), int(end))

    def search(self, query, label, own, same: bool, lows, highs, k: int):
        """Per window (a score between its low and high) the k best (ids, scores) of this label, or of all others."""
        size = float(norms(query))
        scale = size * self.largest
        unit = np.append(query / size, 0.0) if size and np.isfinite(scale) else None
        found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in lows]
        kth = [LEAST] * len(lows)  # the worst of a window that has k
        least = np.array(lows, np.float64)  # what a window still takes
        most = np.array(highs, np.float64)
        heap = [(-np.inf, 0, -np.inf, np.inf)]
        while heap:
            _, node, low, high = heapq.heappop(heap)
            open_ = (high >= least) & (low <= most)
            if not open_.any():
                continue
            if self.children[node] is not None:
                there = self.children[node]
                if unit is None:
                    low, high = np.full((2, there.stop - there.start), [[-np.inf], [np.inf]])
                else:
                    low, high = bounds(self.centres[there] @ unit, self.radius[there])
                    low, high = low * scale, high * scale
                for n in np.flatnonzero(((high[:, None] >= least) & (low[:, None] <= most)).any(axis=1)):
                    heapq.heappush(heap, (-high[n], there.start + int(n), low[n], high[n]))
                continue
            rows = self.rows[node]
            scores, ids = products(self.vectors[rows], query, self.top), self.ids[rows]
            fits = ((self.labels[rows] == label) == same) & (ids != own)
            for w in np.flatnonzero(open_):
                fit = np.flatnonzero(fits & (scores >= max(lows[w], kth[w])) & (scores <= highs[w]))
                if not len(fit):
                    continue
                i, s = np.concatenate([found[w][0], ids[fit]]), np.concatenate([found[w][1], scores[fit]])
                top = np.lexsort((i, ~s))[:k]  # ~s falls as s rises, without an overflow
                found[w] = i[top], s[top]
                if len(top) == k:
                    kth[w] = int(s[top[-1]])
                    least[w] = max(least[w], float(kth[w]))
        return found


def _stored(rows) -> dict[int, np.ndarray]:
    """The vectors of a sample by width, in a fixed order."""
    out: dict[int, list[bytes]] = {}
    for width, vec in sorted(rows):
        out.setdefault(width, []).append(vec)
    return {w: np.frombuffer(b"".join(v), np.float64).reshape(len(v), w) for w, v in out.items()}


class Top:
    """The tree's top level: per width the centres of the cells, and once they are known their covering radii."""

    def __init__(self, sample: dict[int, np.ndarray], counts: dict[int, int], largest: dict[int, float]):
        self.largest, self.centres, self.radius = largest, {}, {}
        for width, vectors in sample.items():
            points = augmented(vectors, largest[width])
            picked, _, _ = farthest_first(points, min(CELLS, -(-counts[width] // CELL)))
            self.centres[width] = points[picked]

    def cell(self, width: int, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell of each vector and the distance to its centre; a width that was not drawn is one cell."""
        if width not in self.centres:
            return np.zeros(len(vectors), np.int64), np.full(len(vectors), 2.0)
        points, centres = augmented(vectors, self.largest[width]), self.centres[width]
        cell = (points @ centres.T).argmax(axis=1)
        return cell, np.sqrt(((points - centres[cell]) ** 2).sum(axis=1))

    def bounds(self, width: int, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and largest product of the query in each cell."""
        size = float(norms(query))
        scale = size * self.largest[width]
        if width not in self.centres or not size or not np.isfinite(scale):
            cells = len(self.centres.get(width, [0]))
            return np.full(cells, -np.inf), np.full(cells, np.inf)
        low, high = bounds(self.centres[width] @ np.append(query / size, 0.0), self.radius[width])
        return low * scale, high * scale


def _by_width(batch):
    widths = batch["width"].to_numpy(zero_copy_only=False)
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        yield int(width), rows, matrix(batch["vec"].take(pa.array(rows)), int(width))


def _place(top):
    """Adds cell and away."""

    def run(batches):
        for batch in batches:
            cell, away = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            for width, rows, vectors in _by_width(batch):
                cell[rows], away[rows] = top.value.cell(width, vectors)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(away)], [*batch.schema.names, "cell", "away"])

    return run


def _visits(top, skip_own: bool):
    """A row per cell that the anchor has to visit: ``cell`` is replaced, or all but it with ``skip_own``."""

    def run(batches):
        for batch in batches:
            own, lows, highs = (batch[c].to_pylist() for c in ("cell", "lows", "highs"))
            picked, cells = [], []
            for width, rows, vectors in _by_width(batch):
                for i, query in zip(rows, vectors, strict=True):
                    low, high = top.value.bounds(width, query)
                    wanted = (high[:, None] >= np.array(lows[i], float)) & (low[:, None] <= np.array(highs[i], float))
                    there = np.flatnonzero(wanted.any(axis=1))
                    there = there[there != own[i]] if skip_own else there
                    picked.append(np.full(len(there), i))
                    cells.append(there)
            at = batch.schema.get_field_index("cell")
            rows = batch.take(pa.array(np.concatenate([*picked, []]).astype(np.int64)))
            yield rows.set_column(at, "cell", pa.array(np.concatenate([*cells, []]).astype(np.int32)))

    return run


_KEY = ["width", "cell", "part", "block"]
_ASK = ["vec_id", "label", "vec", "lows", "highs"]


def _search(k: int, same: bool):
    """(anchor_id, window, vec_id, score) from rows sorted by _KEY and ``ask``: a part's candidates, then its anchors."""

    def run(batches):
        key, held, tree = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in [*_KEY, "ask"]])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            out = ([], [], [], [])
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                here, rows = tuple(keys[:4, a]), batch.slice(a, b - a)
                if here != key:
                    key, held, tree = here, [], None
                width = int(here[0])
                if not keys[4, a]:
                    held.append((matrix(rows["vec"], width), rows["vec_id"].to_numpy(), rows["label"].to_numpy()))
                    continue
                if tree is None:
                    if not held:
                        continue
                    tree, held = CoverTree(*(np.concatenate(x) for x in zip(*held, strict=True))), held[:0]
                queries = matrix(rows["vec"], width)
                for q, i, label, low, high in zip(queries, *(rows[c].to_pylist() for c in ("vec_id", "label", "lows", "highs")), strict=True):
                    for w, (ids, scores) in enumerate(tree.search(q, label, i, same, low, high, k)):
                        for column, values in zip(out, ([i] * len(ids), [w] * len(ids), ids, scores), strict=True):
                            column.extend(values)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(out, kinds, strict=True)], ["anchor_id", "window", "vec_id", "score"]
            )

    return run


def _meet(cells: DataFrame, asks: DataFrame, k: int, same: bool) -> DataFrame:
    """The k best of each window in each part of the cells that anchors visit.

    A cell is cut into parts of PART_BYTES, and more than BLOCK anchors of a cell pass in several tasks, so a task
    holds one part at a time, however many rows are close to a centre.
    """
    n = partitions(cells.sparkSession)
    sizes = cells.groupBy("width", "cell").agg(F.count(F.lit(1)).alias("rows"))
    sizes = sizes.withColumn("parts", F.ceil(F.col("rows") * F.greatest("width", F.lit(1)) * 8 / PART_BYTES).cast("int"))
    callers = asks.groupBy("width", "cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    grid = sizes.join(callers, ["width", "cell"]).drop("rows")
    own, nothing = F.xxhash64("vec_id", F.lit(5)), F.lit(None).cast("array<bigint>")
    left = split_join(cells.withColumn("lows", nothing).withColumn("highs", nothing), grid, ["width", "cell"], "inner").select(
        "width", "cell", F.pmod(own, F.col("parts")).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("ask"), *_ASK,
    )
    right = split_join(asks, grid, ["width", "cell"], "inner").select(
        "width", "cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.pmod(own, F.col("blocks")).cast("int").alias("block"), F.lit(1).alias("ask"), *_ASK,
    )
    met = left.unionByName(right).repartition(n, *_KEY).sortWithinPartitions(*_KEY, "ask")
    return met.mapInArrow(_search(k, same), "anchor_id bigint, window int, vec_id bigint, score bigint")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def windows(scores) -> tuple[F.Column, F.Column]:
    """The least and the largest score that a negative may have beside positives of these scores."""
    percent = lambda s, share: s.cast("decimal(20,0)") * F.lit(share).cast("decimal(3,0)") / F.lit(100).cast("decimal(3,0)")
    lows = F.transform(scores, lambda s: F.ceil(percent(s, LOW)).cast("long"))
    return lows, F.transform(scores, lambda s: F.floor(percent(s, HIGH)).cast("long"))


def hard_negatives(vectors: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of ``vectors`` (vec_id, embedding,
    label).

    Anchors are rows whose vec_id is divisible by ``every``. Rows without id, label or vector, or with a null or
    non-finite component (also one that scaling makes infinite), take no part. Only vectors of one width are
    compared, an empty one with other empty ones. Of rows with the same vec_id one is kept, the one with the smallest
    label and bytes. Zero vectors take part. Equal scores go by the smaller vec_id; a score beyond 64 bits is the nearest
    long. Anchors without positives, or without a negative in a window, give no rows, nor does an empty table. Extra
    columns are not read and may have any name.
    """
    spark = vectors.sparkSession
    ship(spark)
    columns = "vec_id bigint, label bigint, width int, norm double, vec binary"
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    slim = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), "embedding")
    clean = slim.mapInArrow(_prepare, columns).groupBy("vec_id").agg(F.min(F.struct("label", "vec", "width", "norm")).alias("v"))
    clean = materialise(clean.select("vec_id", "v.label", "v.width", "v.norm", "v.vec"), "vectors")
    stats = clean.groupBy("width").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("norm")).collect()  # a row per width
    counts, n = {r.width: r.n for r in stats}, sum(r.n for r in stats)
    share = SAMPLE / max(1, n) * (1 << 20)
    drawn = clean.where(F.pmod(F.xxhash64("vec_id", F.lit(4)), F.lit(1 << 20)) < share).select("width", "vec").collect()
    top = Top(_stored((r.width, bytes(r.vec)) for r in drawn), counts, {r.width: r.norm for r in stats})
    placed = clean.mapInArrow(_place(spark.sparkContext.broadcast(top)), f"{columns}, cell int, away double")
    cells = materialise(placed.drop("norm"), "cells")
    radii = cells.groupBy("width", "cell").agg(F.max("away").alias("r")).collect()  # SAMPLE at most, and a row per width
    top.radius = {w: np.zeros(len(c)) for w, c in top.centres.items()}
    for r in radii:
        if r.width in top.radius:
            top.radius[r.width][r.cell] = r.r
    level = spark.sparkContext.broadcast(top)  # SAMPLE vectors at most

    cells = cells.drop("away")
    fields = "vec_id bigint, label bigint, vec binary, width int, cell int"
    asked = f"{fields}, lows array<bigint>, highs array<bigint>"
    # Columns of their own, since anchors meet the rows they were taken from.
    anchors = cells.where(F.col("vec_id") % every == 0).select(*[F.col(c).alias(c) for c in ("vec_id", "label", "vec", "width", "cell")])
    open_ = anchors.withColumns({"lows": F.array(F.lit(LEAST)), "highs": F.array(F.lit(MOST))})
    first = materialise(_meet(cells, open_, positives, True), "first")
    known = _best(first, positives).groupBy("anchor_id").agg(F.count(F.lit(1)).alias("m"), F.min("score").alias("least"))
    bounded = anchors.join(known, anchors.vec_id == known.anchor_id, "left")
    least = F.when(F.col("m") >= positives, F.col("least")).otherwise(LEAST)
    bounded = bounded.select(*anchors.columns, F.array(least).alias("lows"), F.array(F.lit(MOST)).alias("highs"))
    onward = materialise(bounded.mapInArrow(_visits(level, True), asked), "onward")
    second = _meet(cells, onward, positives, True)
    best = materialise(_best(first.unionByName(second), positives).select("anchor_id", "rank", "vec_id", "score"), "positives")
    lists = best.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("p"))
    lows, highs = windows(F.col("p.score"))
    asks = anchors.join(lists, anchors.vec_id == lists.anchor_id).select(*anchors.columns, lows.alias("lows"), highs.alias("highs"))
    found = _best(_meet(cells, materialise(asks.mapInArrow(_visits(level, False), asked), "asks"), negatives, False), negatives)
    found = found.select("anchor_id", (F.col("window") + 1).alias("place"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    # Windows are numbered in the order of the positives.
    chosen = best.select("anchor_id", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = found.join(chosen, ["anchor_id", "place"])
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""
