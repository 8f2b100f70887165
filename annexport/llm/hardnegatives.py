"""Hard-negative mining with STR-packed R-trees over integer vectors.

Every component x becomes floor(scale * x); the score of two rows is their integer inner product. For each anchor, its
positives are the best other rows of its label; for each of them the hard negatives are the best rows of other labels
whose score lies in a window below the positive's.

Index. Rows are tiled as STR does (sort, cut into slabs, sort each slab by the next coordinate): ranges of the
coordinate that varies most are the partitions, each is sorted by the second and cut into tiles of ``TILE`` rows,
and within a tile the same goes on down to leaves of ``LEAF`` rows. Ties are parted by id, so that equal vectors spread
too. A tile is written as one row: its points in leaf order and the minimum bounding box of every leaf and
inner node. From a box, the sum over the coordinates of the larger (smaller) product bounds the inner product with an anchor from
above (below).

Search. Anchors are the stated query set; they go to the tasks in blocks of at most ``ANCHORS``, each searched
against all tiles. A task takes an anchor through its tiles with a queue of boxes, best upper bound first. A box is pruned if
it lies outside the score window, or if its upper bound is strictly below the score of the last
row the anchor would keep; an equal bound may hide a smaller id. A task hands on the rows it would keep
of each anchor, and a window function takes the best of those. Tiles do not depend on the anchors, so a lost task is run again alone.

In many dimensions the boxes of spread vectors overlap and few are pruned; results are exact either way.

Edge cases: rows with a NULL id, label or vector, or with a NULL or non-finite component take no part. Shorter vectors
count as filled up with zeros. Higher scores come first, ties by smaller id. "Other" rows have
another id; repeated rows each count, also as anchors. Anchors without positives, and positives without negatives in
their window, give no row. Components so large that inner products leave the integers that doubles hold exactly
are refused. An empty table gives an empty result. Extra columns of any name are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from annexport.llm.common import give_back, in_batches
from annexport.session import staged

SCALE = 256
KEPT = 5  # positives of an anchor, negatives of a positive
LOW = 80  # per cent of the positive's score that a negative's must reach
TILE = 4096  # rows
LEAF = 256  # rows
FANOUT = 4
ANCHORS = 8192  # rows of a block
EXACT = 2**53


# --- the tree of a tile


def str_order(points: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Places of the points in leaf order: sorted and cut along the three coordinates that vary most."""
    axes = np.argsort(-points.var(axis=0), kind="stable")[:3] if points.size else []

    def tiled(places: np.ndarray, axes) -> np.ndarray:
        if len(axes) == 0 or len(places) <= leaf:
            return places
        places = places[np.argsort(points[places, axes[0]], kind="stable")]
        leaves = -(-len(places) // leaf)
        slabs = int(np.ceil(leaves ** (1 / len(axes))))
        width = -(-leaves // slabs) * leaf
        return np.concatenate([tiled(places[k : k + width], axes[1:]) for k in range(0, len(places), width)])

    return tiled(np.arange(len(points)), axes)


class Tree:
    """Boxes of a tile in levels, the leaves first; node k of a level covers nodes FANOUT * k ... of the one below."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF) -> None:
        self.points, self.leaf = points.astype(np.float64), leaf
        cuts = np.arange(0, len(points), leaf)
        self.lows, self.highs = [np.minimum.reduceat(self.points, cuts)], [np.maximum.reduceat(self.points, cuts)]
        while len(self.lows[-1]) > 1:
            cuts = np.arange(0, len(self.lows[-1]), FANOUT)
            self.lows.append(np.minimum.reduceat(self.lows[-1], cuts))
            self.highs.append(np.maximum.reduceat(self.highs[-1], cuts))

    def bounds(self, anchors: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """By level, the least and largest inner product an anchor can have with a point of each box."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        least = [up @ lo.T + down @ hi.T for lo, hi in zip(self.lows, self.highs)]
        most = [up @ hi.T + down @ lo.T for lo, hi in zip(self.lows, self.highs)]
        return least, most

    def search(self, anchor: np.ndarray, least, most, pruned: Callable, visit: Callable) -> int:
        """Visits leaves, best upper bound first, until nothing is left that is not pruned. Returns how many.

        ``least`` and ``most`` are the anchor's bounds by level; ``visit`` gets the rows of a leaf and their scores.
        """
        top = len(most) - 1
        queue = [(-most[top][0], top, 0)]
        visited = 0
        while queue:
            bound, level, k = heapq.heappop(queue)
            if pruned(least[level][k], -bound):
                continue
            if level == 0:
                rows = slice(k * self.leaf, (k + 1) * self.leaf)
                visit(rows, self.points[rows] @ anchor)
                visited += 1
                continue
            for child in range(FANOUT * k, min(FANOUT * (k + 1), len(most[level - 1]))):
                if not pruned(least[level - 1][child], most[level - 1][child]):
                    heapq.heappush(queue, (-most[level - 1][child], level - 1, child))
        return visited


class Best:
    """The first ``KEPT`` of the (score, id) offered: higher scores, then smaller ids."""

    __slots__ = ("rows", "last")

    def __init__(self) -> None:
        self.rows: list[tuple[float, int]] = []  # (-score, id), sorted
        self.last = -np.inf  # the score a row must reach

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        near = scores >= self.last
        if near.any():
            scores, ids = scores[near], ids[near]
            if len(scores) > KEPT:
                worth = scores >= np.partition(scores, -KEPT)[-KEPT]
                scores, ids = scores[worth], ids[worth]
            self.rows = heapq.nsmallest(KEPT, [*self.rows, *zip((-scores).tolist(), ids.tolist())])
            if len(self.rows) == KEPT:
                self.last = -self.rows[-1][0]


# --- tiles


TILES = "ids binary, labels binary, points binary"


def _packed(dims: int, rows_each: int) -> Callable:
    """Tiles from rows (id, label, point), in their order."""

    def tile(ids: np.ndarray, labels: np.ndarray, points: np.ndarray) -> pa.RecordBatch:
        order = str_order(points)
        cells = [ids[order].tobytes(), labels[order].tobytes(), points[order].astype(np.int32).tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in cells], names=["ids", "labels", "points"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        n = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append((*(batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1)), matrix(batch.column(2), dims)))
            n += batch.num_rows
            while n >= rows_each:
                ids, labels, points = (np.concatenate(x) for x in zip(*held))
                yield tile(ids[:rows_each], labels[:rows_each], points[:rows_each])
                held, n = [(ids[rows_each:], labels[rows_each:], points[rows_each:])], n - rows_each
        if n:
            yield tile(*(np.concatenate(x) for x in zip(*held)))
        give_back()

    return run


def matrix(lists: pa.ListArray, dims: int) -> np.ndarray:
    """Rows of ``dims`` numbers; shorter lists end in zeros."""
    values, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
    sizes = np.diff(ends, prepend=0)
    out = np.zeros((len(sizes), dims), np.int64)
    place = np.arange(len(values)) - np.repeat(ends - sizes, sizes)
    out[np.repeat(np.arange(len(sizes)), sizes), place] = values
    return out


def _trees(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[Tree, np.ndarray, np.ndarray]]:
    for batch in batches:
        for ids, labels, points in zip(*(batch.column(k) for k in range(3))):
            yield (
                Tree(np.frombuffer(points.as_py(), np.int32).reshape(len(ids.as_py()) // 8, dims)),
                np.frombuffer(ids.as_py(), np.int64), np.frombuffer(labels.as_py(), np.int64),
            )


# --- search


FOUND = "a long, p int, score long, id long"
_FOUND = pa.schema([("a", pa.int64()), ("p", pa.int32()), ("score", pa.int64()), ("id", pa.int64())])


def _rows(found: Iterator[tuple[int, int, Best]]) -> pa.RecordBatch:
    cells = [(a, p, -int(s), i) for a, p, best in found for s, i in best.rows]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*cells) if cells else [[]] * 4, _FOUND.types)], schema=_FOUND)


def _positives(shared, dims: int) -> Callable:
    """The best rows of each anchor's label, among the tiles of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, own_ids, own_labels, anchors = shared.value
        best = [Best() for _ in keys]
        for tree, ids, labels in _trees(batches, dims):
            least, most = tree.bounds(anchors)
            for a, found in enumerate(best):

                def visit(rows: slice, scores: np.ndarray) -> None:
                    mine = (labels[rows] == own_labels[a]) & (ids[rows] != own_ids[a])
                    found.offer(scores[mine], ids[rows][mine])

                tree.search(anchors[a], [x[a] for x in least], [x[a] for x in most], lambda _, upper: upper < found.last, visit)
        yield _rows((int(k), 0, b) for k, b in zip(keys, best))
        give_back()

    return run


def _negatives(shared, dims: int, low: int) -> Callable:
    """The best rows of other labels in the window of each positive's score, among the tiles of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, own_ids, own_labels, anchors, scores_of = shared.value
        best = [[Best() for _ in s] for s in scores_of]
        for tree, ids, labels in _trees(batches, dims):
            least, most = tree.bounds(anchors)
            for a, (found, windows) in enumerate(zip(best, scores_of)):
                if not found:
                    continue

                def pruned(lower: float, upper: float) -> bool:
                    return all(100 * upper < low * p or lower > p or upper < b.last for b, p in zip(found, windows))

                def visit(rows: slice, scores: np.ndarray) -> None:
                    other = (labels[rows] != own_labels[a]) & (scores <= windows[0]) & (100 * scores >= low * windows[-1])
                    if other.any():
                        s, i = scores[other], ids[rows][other]
                        for b, p in zip(found, windows):
                            inside = (s <= p) & (100 * s >= low * p)
                            b.offer(s[inside], i[inside])

                tree.search(anchors[a], [x[a] for x in least], [x[a] for x in most], pruned, visit)
        yield _rows((int(k), p, b) for k, found in zip(keys, best) for p, b in enumerate(found))
        give_back()

    return run


def _first(rows: DataFrame) -> DataFrame:
    """The first ``KEPT`` rows by anchor and positive, with their rank."""
    order = Window.partitionBy("a", "p").orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= KEPT)


def vectors(rows: DataFrame, identifier: str, vector: str, label: str, scale: int) -> DataFrame:
    """(id, label, point) of the rows that take part."""
    finite = F.forall(F.col(vector), lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return rows.where(
        F.col(identifier).isNotNull() & F.col(label).isNotNull() & F.coalesce(finite, F.lit(False))
    ).select(
        F.col(identifier).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
        F.transform(F.col(vector), lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("point"),
    )


def _extent(rows: DataFrame) -> tuple[int, int, list[int]]:
    """Rows, dimensions, and the two coordinates that vary most. A row per dimension reaches the driver."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = matrix(batch.column(0), int(max(batch.column(0).value_lengths().to_pylist(), default=0)))
            if points.size:
                x = points.astype(np.float64)
                cells = [np.arange(x.shape[1]), x.sum(0), (x * x).sum(0), np.abs(x).max(0)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cells], names=["j", "s", "q", "m"])

    n = rows.count()
    by = rows.select("point").mapInArrow(sums, "j long, s double, q double, m double").groupBy("j").agg(
        F.sum("s").alias("s"), F.sum("q").alias("q"), F.max("m").alias("m")
    ).collect()
    most = max((r.m for r in by), default=0.0)
    if 100 * most * most * max(len(by), 1) >= EXACT:
        raise ValueError("components are too large for exact inner products")
    axes = sorted(by, key=lambda r: (-(r.q - r.s * r.s / n), r.j))[:2]
    return n, len(by), [r.j for r in axes]


def hard_negatives(
    rows: DataFrame, anchor: Column | str, identifier: str = "vec_id", vector: str = "embedding", label: str = "label",
    scale: int = SCALE, low: int = LOW, tile: int = TILE, anchors_each: int = ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score); ``anchor`` says which rows are
    anchors, in terms of ``id`` and ``label``."""
    spark = rows.sparkSession
    own = staged(vectors(in_batches(rows), identifier, vector, label, scale), "vectors")
    n, dims, axes = _extent(own)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slabs = max(1, -(-n // (4 * tile)), min(tasks, -(-n // (tile // 4))))
    key = [F.coalesce(F.get("point", F.lit(j)), F.lit(0)) for j in axes]
    tiled = own.withColumns({f"x{k}": x for k, x in enumerate(key)})
    tiled = tiled.repartitionByRange(slabs, *[f"x{k}" for k in range(len(key))], "id").sortWithinPartitions(
        *[f"x{k}" for k in reversed(range(len(key)))], "id"
    )
    tiles = staged(tiled.select("id", "label", "point").mapInArrow(_packed(dims, tile), TILES), "tiles")
    asked = staged(own.where(anchor).withColumn("a", F.monotonically_increasing_id()), "anchors")
    blocks = max(1, -(-asked.count() // (anchors_each // 2)))
    out = None
    for k in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("a"), F.lit(blocks)) == k).select("a", "id", "label", "point").toArrow().sort_by("a")
        keys, ids, labels = (mine.column(c).to_numpy() for c in ("a", "id", "label"))
        points = matrix(mine.column("point").combine_chunks(), dims).astype(np.float64) if len(keys) else np.zeros((0, dims))
        shared = spark.sparkContext.broadcast((keys, ids, labels, points))
        best = _first(tiles.mapInArrow(_positives(shared, dims), FOUND)).select("a", "score", "id", "rank").toArrow()
        best = best.sort_by([("a", "ascending"), ("rank", "ascending")])
        of = {int(a): ([], []) for a in keys}
        for a, score, i in zip(*(best.column(c).to_pylist() for c in ("a", "score", "id"))):
            of[a][0].append(score)
            of[a][1].append(i)
        windows = [of[int(a)][0] for a in keys]
        shared = spark.sparkContext.broadcast((keys, ids, labels, points, windows))
        found = _first(tiles.mapInArrow(_negatives(shared, dims, low), FOUND))
        named = spark.createDataFrame(pa.table({
            "a": pa.array([a for a in of for _ in of[a][0]], pa.int64()),
            "p": pa.array([p for a in of for p in range(len(of[a][0]))], pa.int32()),
            "anchor_id": pa.array([i for a, i in zip(keys.tolist(), ids.tolist()) for _ in of[a][0]], pa.int64()),
            "positive_id": pa.array([i for a in of for i in of[a][1]], pa.int64()),
            "positive_score": pa.array([s for a in of for s in of[a][0]], pa.int64()),
        }))
        block = found.join(named, ["a", "p"]).select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"),
        )
        block = staged(block, "negatives") if blocks > 1 else block
        out = block if out is None else out.unionByName(block)
    return out
