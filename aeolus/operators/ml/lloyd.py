"""K-means fits side by side over blocks of points in kd order.

A block holds some hundred thousand points of one task, sorted into a kd tree,
with count, sum, sum of squares and bounding box of every node that a pass looks
at. A pass serves all fits that still move: a node whose box lies on one center's
side of all bisecting planes adds its sums to that center as a whole (the
filtering algorithm of Kanungo et al.), and only points of leaves that a plane
cuts are compared one by one. The assignment is Lloyd's own, point by point.
Only sums of centers reach the driver, one row a task, whatever the points.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...session import ensure_checkpoint_dir, scratch_path

#: Points of a block at most, and of a leaf of its tree; points compared at once.
BLOCK_POINTS, LEAF_POINTS, SLAB_POINTS = 1 << 17, 64, 1 << 15
#: Binary splits between two levels that a pass looks at.
SPLITS = 3
#: Rounds of sampling and candidates a round and center, as ``pyspark.ml`` has them;
#: rounds over the weighted candidates.
INIT_STEPS, OVERSAMPLING, LOCAL_ITERATIONS = 2, 2, 30
TOLERANCE = 1e-6

_BLOCK = "block long, points long, dims int, rows binary, nodes binary"


# ---- trees -------------------------------------------------------------------

def _depths(n: int) -> list[int]:
    """Depths of the levels that are kept, the leaves' last."""
    last = max(0, int(np.ceil(np.log2(max(n, 1) / LEAF_POINTS))))
    return list(range(last % SPLITS, last + 1, SPLITS))


def _bounds(n: int, depth: int) -> np.ndarray:
    """Where the nodes of a depth begin, and the end; children nest in parents."""
    return (np.arange((1 << depth) + 1) * n) >> depth


class Tree:
    """A block: points (dims x n, in kd order) and the levels' nodes."""

    def __init__(self, rows: np.ndarray, nodes: np.ndarray):
        self.rows = rows
        dims, n = rows.shape
        self.levels, at = [], 0
        for depth in _depths(n):
            level = nodes[:, at:at + (1 << depth)]
            at += 1 << depth
            self.levels.append((level[:dims], level[dims:2 * dims], level[2 * dims:]))
        self.bounds = _bounds(n, _depths(n)[-1])

    @classmethod
    def of(cls, points: np.ndarray) -> "Tree":
        """Halves each node along its widest side, all nodes of a depth at once."""
        n, dims = points.shape
        depths = _depths(n)
        for depth in range(depths[-1]):
            bounds = _bounds(n, depth)
            wide = np.maximum.reduceat(points, bounds[:-1]) - np.minimum.reduceat(points, bounds[:-1])
            node = np.repeat(np.arange(1 << depth), np.diff(bounds))
            along = points[np.arange(n), wide.argmax(1)[node]]
            points = points[np.lexsort((along, node))]
        nodes = []
        for depth in depths:
            begin = _bounds(n, depth)[:-1]
            low, high = np.minimum.reduceat(points, begin), np.maximum.reduceat(points, begin)
            nodes.append(np.column_stack([
                (low + high) / 2, (high - low) / 2, np.diff(_bounds(n, depth)),
                np.add.reduceat((points * points).sum(1), begin), np.add.reduceat(points, begin)]).T)
        return cls(np.ascontiguousarray(points.T), np.concatenate(nodes, axis=1))

    def nodes(self) -> np.ndarray:
        return np.concatenate([np.concatenate(level) for level in self.levels], axis=1)

    def points_of(self, leaves: np.ndarray) -> np.ndarray:
        """Places of the leaves' points, one leaf after the other."""
        begin, size = self.bounds[leaves], self.bounds[leaves + 1] - self.bounds[leaves]
        return np.arange(size.sum()) + np.repeat(begin - np.cumsum(size) + size, size)


def _nearest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of columns of ``x``: the nearest center (the first of equals), its squared
    distance and all centers', both without the column's own square."""
    g = (-2 * centers) @ x + (centers * centers).sum(1)[:, None]
    best, label = g[0].copy(), np.zeros(x.shape[1], np.intp)
    for k in range(1, len(g)):
        label[g[k] < best] = k
        np.minimum(best, g[k], out=best)
    return label, best, g


def center_sums(tree: Tree, centers: np.ndarray) -> np.ndarray:
    """Count, sum of squares and sum of the points nearest to each center."""
    k = len(centers)
    total = np.zeros((k, tree.rows.shape[0] + 2))
    apart = np.abs(centers[:, None] - centers[None])  # of two centers, by dimension
    nodes = np.arange(tree.levels[0][0].shape[1])
    for middle, half, sums in tree.levels:
        label, best, g = _nearest(middle[:, nodes], centers)
        # The most that the box's corners gain on a center against the middle.
        gain = sum(h[:, None] * apart[label, :, i] for i, h in enumerate(half[:, nodes]))
        ahead = g.T - best[:, None] > 2 * gain  # equal ones are told apart point by point
        ahead[np.arange(len(label)), label] = True
        sure = ahead.all(1)
        own = np.zeros((k, sure.sum()))
        own[label[sure], np.arange(own.shape[1])] = 1
        total += own @ sums[:, nodes[sure]].T
        cut = nodes[~sure]
        nodes = (cut[:, None] * (1 << SPLITS) + np.arange(1 << SPLITS)).ravel()
    places = tree.points_of(cut)
    for at in range(0, len(places), SLAB_POINTS):
        x = tree.rows[:, places[at:at + SLAB_POINTS]]
        label = _nearest(x, centers)[0]
        for column, w in enumerate([None, (x * x).sum(0), *x]):
            total[:, column] += np.bincount(label, w, minlength=k)
    return total


def cost_of(sums: np.ndarray, centers: np.ndarray) -> float:
    """Squared distances to the centers, from their points' sums."""
    count, squares, total = sums[:, 0], sums[:, 1], sums[:, 2:]
    each = squares - 2 * (centers * total).sum(1) + count * (centers * centers).sum(1)
    return float(np.maximum(each, 0).sum())


def far_points(tree: Tree, centers: np.ndarray, rate: float, rng: np.random.Generator) -> np.ndarray:
    """Each point by itself with probability ``rate`` times its squared distance
    to the centers. A leaf's points are first drawn by what its farthest corner
    would have, then kept by their own share of that."""
    middle, half, _ = tree.levels[-1]
    most = np.full(middle.shape[1], np.inf)
    for c in centers:
        corner = np.abs(middle - c[:, None]) + half
        np.minimum(most, (corner * corner).sum(0), out=most)
    # A little more than the bound, for rounding.
    share = np.minimum(1.0, rate * most * (1 + 1e-9))
    size = np.diff(tree.bounds)
    drawn = rng.binomial(size, share)
    out = []
    for leaf in np.flatnonzero(drawn):
        x = tree.rows[:, tree.bounds[leaf] + rng.choice(size[leaf], drawn[leaf], replace=False)]
        own = ((x[:, None] - centers.T[:, :, None]) ** 2).sum(0).min(0)
        out.append(x[:, rng.random(x.shape[1]) * share[leaf] < rate * own])
    return np.concatenate(out, axis=1).T if out else np.empty((0, len(middle)))


def silhouette_sum(tree: Tree, centers: np.ndarray, sums: np.ndarray) -> float:
    """Squared Euclidean silhouettes added up, as ``ClusteringEvaluator`` has
    them: mean distances to a cluster follow from its sums."""
    some = np.flatnonzero(sums[:, 0] > 0)
    count, spread = sums[some, 0], sums[some, 1] / sums[some, 0]
    mean = sums[some, 2:] / count[:, None]
    total = 0.0
    for at in range(0, tree.rows.shape[1], SLAB_POINTS):
        x = tree.rows[:, at:at + SLAB_POINTS]
        label = _nearest(x, centers[some])[0]
        to = np.maximum((x * x).sum(0) - 2 * mean @ x + spread[:, None], 0)
        every = np.arange(len(label))
        own = to[label, every] * (count / np.maximum(count - 1, 1))[label]
        to[label, every] = np.inf
        other = to.min(0)
        worst = np.maximum(own, other)
        value = np.divide(other - own, worst, out=np.zeros_like(own), where=worst > 0)
        total += float(value[count[label] > 1].sum())
    return total


# ---- blocks ------------------------------------------------------------------

@dataclass
class Blocks:
    """Points as written blocks. ``sizes``: (block, points), by block."""
    table: DataFrame
    sizes: list[tuple[int, int]]

    @property
    def n(self) -> int:
        return sum(points for _, points in self.sizes)

    def each(self, work, schema: str) -> list:
        """Rows of ``work(trees)``, where trees are a task's (block, tree)."""
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from work(_trees(batches))
        return self.table.mapInArrow(task, schema).collect()

    def totals(self, of, shapes: list[tuple[int, ...]]) -> list[np.ndarray]:
        """``of(tree)``, a list of arrays of the shapes, added up over all blocks."""
        def add(trees):
            total = None
            for _, tree in trees:
                flat = np.concatenate([np.ravel(a) for a in of(tree)])
                total = flat if total is None else total + flat
            if total is not None:
                yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary())})
        ends = np.cumsum([int(np.prod(s)) for s in shapes])
        total = np.zeros(ends[-1])
        for row in self.each(add, "sums binary"):
            total += np.frombuffer(row["sums"])
        return [part.reshape(s) for part, s in zip(np.split(total, ends[:-1]), shapes)]

    def points(self, of) -> list[tuple[int, np.ndarray]]:
        """(job, points) that ``of(block, tree)`` gives: few, they go to the driver."""
        def take(trees):
            for block, tree in trees:
                got = [(job, x) for job, x in of(block, tree) if len(x)]
                if got:
                    yield pa.RecordBatch.from_pydict({
                        "block": pa.array([block] * len(got), pa.int64()),
                        "job": pa.array([job for job, _ in got], pa.int32()),
                        "dims": pa.array([x.shape[1] for _, x in got], pa.int32()),
                        "x": pa.array([np.ascontiguousarray(x).tobytes() for _, x in got], pa.binary())})
        rows = self.each(take, "block long, job int, dims int, x binary")
        return [(r["job"], np.frombuffer(r["x"]).reshape(-1, r["dims"]))
                for r in sorted(rows, key=lambda r: (r["job"], r["block"]))]


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Tree]]:
    for batch in batches:
        for block, dims, rows, nodes in zip(*(batch.column(c) for c in ("block", "dims", "rows", "nodes"))):
            d = dims.as_py()
            yield block.as_py(), Tree(np.frombuffer(rows.as_buffer()).reshape(d, -1),
                                      np.frombuffer(nodes.as_buffer()).reshape(3 * d + 2, -1))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's points as blocks, one row each."""
    def block(parts):
        points = np.concatenate(parts)
        if not np.isfinite(points).all():
            raise ValueError("points must be neither NaN nor infinite")
        tree = Tree.of(points)
        number = (TaskContext.get().partitionId() << 32) + made
        return pa.RecordBatch.from_pydict({
            "block": pa.array([number], pa.int64()), "points": pa.array([len(points)], pa.int64()),
            "dims": pa.array([points.shape[1]], pa.int32()),
            "rows": pa.array([tree.rows.tobytes()], pa.binary()),
            "nodes": pa.array([tree.nodes().tobytes()], pa.binary())})

    held, made, parts = 0, 0, []
    for batch in batches:
        if not len(batch):
            continue
        points = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
        while len(points):
            part = points[:BLOCK_POINTS - held]
            points = points[len(part):]
            parts.append(part)
            held += len(part)
            if held == BLOCK_POINTS:
                yield block(parts)
                held, made, parts = 0, made + 1, []
    if parts:
        yield block(parts)


def write_blocks(data: DataFrame) -> Blocks:
    """The ``features`` of all rows as blocks in the shared folder: a file each,
    so that a scan deals them to tasks by their size. A session of their own
    hands workers one block at a time; a batch by default holds all of a task's."""
    spark = data.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, "kmeans", uuid.uuid4().hex[:12])
    made = data.select(vector_to_array("features").alias("x")).mapInArrow(_cut, _BLOCK)
    made.write.option("maxRecordsPerFile", 1).option("compression", "none").parquet(path)
    reader = spark.newSession()
    reader.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    table = reader.read.schema(_BLOCK).parquet(path)
    sizes = sorted((r["block"], r["points"]) for r in table.select("block", "points").collect())
    return Blocks(table.select("block", "dims", "rows", "nodes"), sizes)


# ---- starting centers --------------------------------------------------------

def _seeded(*parts: int) -> np.random.Generator:
    return np.random.default_rng([p & 0xFFFFFFFFFFFFFFFF for p in parts])


def _first_points(blocks: Blocks, jobs: list[tuple[int, int]]) -> list[np.ndarray]:
    """One point a job, drawn from all with the same chance."""
    ends = np.cumsum([points for _, points in blocks.sizes])
    wanted: dict[int, list[tuple[int, int]]] = {}
    for job, (_, seed) in enumerate(jobs):
        at = int(_seeded(seed).integers(blocks.n))
        i = int(np.searchsorted(ends, at, side="right"))
        place = at - (int(ends[i - 1]) if i else 0)
        wanted.setdefault(blocks.sizes[i][0], []).append((job, place))

    def pick(block, tree):
        return [(job, tree.rows[:, place][None]) for job, place in wanted.get(block, ())]
    return [x for _, x in sorted(blocks.points(pick), key=lambda p: p[0])]


def _weighted_start(points: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++ over weighted candidates, then Lloyd's steps among them."""
    centers = points[[rng.choice(len(points), p=weights / weights.sum())]]
    while len(centers) < k:
        far = ((points[:, None] - centers[None]) ** 2).sum(2).min(1)
        chance = weights * far if (weights * far).sum() > 0 else far
        centers = np.vstack([centers, points[rng.choice(len(points), p=chance / chance.sum())]])
    before = None
    for _ in range(LOCAL_ITERATIONS):
        label = ((points[:, None] - centers[None]) ** 2).sum(2).argmin(1)
        if before is not None and (label == before).all():
            break
        before = label
        for c in range(k):
            mine = weights * (label == c)
            if mine.sum() > 0:
                centers[c] = mine @ points / mine.sum()
    return centers


def start_centers(blocks: Blocks, jobs: list[tuple[int, int]]) -> list[np.ndarray]:
    """k-means||: every job's (k, seed) candidates in rounds over all points, far
    points likelier, weighted by the points nearest to them. With no more
    different candidates than k, these are the centers."""
    found = _first_points(blocks, jobs)
    for step in range(INIT_STEPS):
        costs = [cost_of(s, c) for s, c in zip(_sums(blocks, found), found)]
        rates = [min(OVERSAMPLING * k / cost, 1e300) if cost > 0 else 0.0 for (k, _), cost in zip(jobs, costs)]
        now = list(found)

        def draw(block, tree):
            return [(job, far_points(tree, now[job], rates[job], _seeded(seed, k, step, block)))
                    for job, (k, seed) in enumerate(jobs) if rates[job] > 0]
        for job, x in blocks.points(draw):
            found[job] = np.vstack([found[job], x])
    found = [np.unique(x, axis=0) for x in found]
    weights = [s[:, 0] for s in _sums(blocks, found)]
    return [x if len(x) <= k else _weighted_start(x, w, k, _seeded(seed, k, INIT_STEPS))
            for (k, seed), x, w in zip(jobs, found, weights)]


# ---- fits --------------------------------------------------------------------

def _sums(blocks: Blocks, centers: list[np.ndarray]) -> list[np.ndarray]:
    return blocks.totals(lambda tree: [center_sums(tree, c) for c in centers],
                         [(len(c), c.shape[1] + 2) for c in centers])


@dataclass
class Summary:
    trainingCost: float
    numIter: int


@dataclass
class Fit:
    """A fitted k-means, with what the queries use of ``KMeansModel``.
    ``sums``: count, squares and sum of each center's points."""
    centers: np.ndarray
    sums: np.ndarray
    summary: Summary

    def clusterCenters(self) -> list[np.ndarray]:
        return list(self.centers)

    def transform(self, data: DataFrame) -> DataFrame:
        """``cluster``: the nearest center, the first of equals."""
        x = F.col("_x")
        away = F.array(*[sum((x[i] - F.lit(float(v))) * (x[i] - F.lit(float(v))) for i, v in enumerate(c))
                         for c in self.centers])
        return (data.withColumn("_x", vector_to_array("features")).withColumn("_away", away)
                    .withColumn("cluster", (F.array_position("_away", F.array_min("_away")) - 1).cast("int"))
                    .drop("_x", "_away"))


def fit(blocks: Blocks, jobs: list[tuple[int, int]], max_iter: int) -> list[Fit]:
    """Lloyd's iterations of every (k, seed), one pass a step for all that still
    move more than the tolerance. A center without points stays."""
    if not jobs:
        return []
    centers = start_centers(blocks, jobs)
    moving, steps = list(range(len(jobs))), [0] * len(jobs)
    for _ in range(max_iter):
        if not moving:
            break
        left = []
        for job, sums in zip(moving, _sums(blocks, [centers[j] for j in moving])):
            count = sums[:, :1]
            new = np.where(count > 0, sums[:, 2:] / np.maximum(count, 1), centers[job])
            if (((new - centers[job]) ** 2).sum(1) > TOLERANCE * TOLERANCE).any():
                left.append(job)
            centers[job], steps[job] = new, steps[job] + 1
        moving = left
    return [Fit(c, s, Summary(cost_of(s, c), steps[j]))
            for j, (c, s) in enumerate(zip(centers, _sums(blocks, centers)))]


def silhouettes(blocks: Blocks, fits: list[Fit]) -> list[float]:
    """Mean silhouette of each fit, all in one pass."""
    if not fits:
        return []
    models = [(f.centers, f.sums) for f in fits]
    sums = blocks.totals(lambda tree: [np.array([silhouette_sum(tree, c, s)]) for c, s in models],
                         [(1,)] * len(models))
    return [float(s[0]) / blocks.n for s in sums]


# Tasks get this module's code with their work: a cluster's workers need no copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
