"""Hard negatives against brute force, and the tree of a tile on its own."""

import math
import random

import numpy as np
import pytest

from annexport.llm import hardnegatives
from annexport.llm.hardnegatives import Best, Tree, str_order

KIND = "vec_id long, embedding array<float>, label int, id string, point int, a string, p int"
ANCHOR = "id % 10 = 0"


def brute(rows):
    """Each (anchor id, positive id, rank, negative id, scores), in plain loops."""
    good = []
    for i, vector, label, *_ in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        good.append((i, [math.floor(256 * float(np.float32(x))) for x in vector], label))
    out = []
    for i, q, label in good:
        if i % 10:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(q, v)), j, lab) for j, v, lab in good if j != i))
        for s, j, _ in [x for x in scored if x[2] == label][:5]:
            p = -s
            below = [(-t, k) for t, k, lab in scored if lab != label and 80 * p <= -100 * t <= 100 * p]
            out += [(i, j, rank + 1, k, p, t) for rank, (t, k) in enumerate(below[:5])]
    return sorted(out)


def table(rng, n, dims, spread):
    rows = [(k, [rng.gauss(0, spread) for _ in range(dims)], rng.choice([0, 1, 2, None])) for k in range(n)]
    common = [0.25] * dims
    rows += [(n + k, common, rng.randint(0, 3)) for k in range(n // 3)]  # one very common vector: ties
    rows += rows[:15]  # repeated rows, anchors among them
    rows += [(None, common, 1), (-10, common, 1), (2 * n, None, 1), (2 * n + 10, [], 1), (2 * n + 20, [0.5], 2)]
    rows += [(3 * n, [float("nan")] + common[1:], 1), (3 * n + 10, [float("-inf")] + common[1:], 2), (3 * n + 20, [None] + common[1:], 2)]
    rng.shuffle(rows)
    return [(*r, "x", 1, "y", 2) for r in rows]


@pytest.mark.parametrize("dims,tile,anchors", [(3, 64, 20), (8, 4096, 8192), (1, 16, 10)])
def test_equals_brute_force(spark, dims, tile, anchors):
    rows = table(random.Random(dims), 400, dims, 0.3)
    docs = spark.createDataFrame(rows, KIND).repartition(5)
    found = hardnegatives.hard_negatives(docs, ANCHOR, tile=tile, anchors_each=anchors)
    assert sorted(map(tuple, found.collect())) == brute(rows)


@pytest.mark.parametrize("rows", [
    [], [(None, None, None)], [(10, [1.0], 1)], [(10, [], 1), (20, [], 1), (30, [], 2)],
    [(10, [-1.0], 1), (11, [1.0], 1), (12, [1.0], 2)],  # a negative positive score has no window
])
def test_small_tables(spark, rows):
    rows = [(*r, None, None, None, None) for r in rows]
    found = hardnegatives.hard_negatives(spark.createDataFrame(rows, KIND), ANCHOR)
    assert sorted(map(tuple, found.collect())) == brute(rows)


def test_too_large_components_are_refused(spark):
    docs = spark.createDataFrame([(10, [1e30], 1, "", 1, "", 1)], KIND)
    with pytest.raises(ValueError, match="too large"):
        hardnegatives.hard_negatives(docs, ANCHOR)


def test_tree_bounds_and_pruning():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.integers(-9, 9, (700, 4)) + 1000 * centre for centre in rng.integers(-5, 5, (6, 4))])
    points = points[str_order(points, 32)]
    tree = Tree(points, 32)
    anchors = rng.integers(-100, 100, (20, 4)).astype(float)
    least, most = tree.bounds(anchors)
    for k in range(len(tree.lows[0])):
        scores = anchors @ tree.points[32 * k : 32 * k + 32].T
        assert (least[0][:, k] <= scores.min(1)).all() and (most[0][:, k] >= scores.max(1)).all()
    visited = 0
    for a, q in enumerate(anchors):
        best = Best()
        visited += tree.search(
            q, [x[a] for x in least], [x[a] for x in most], lambda _, upper: upper < best.last,
            lambda rows, scores: best.offer(scores, np.arange(len(points))[rows]),
        )
        order = np.lexsort((np.arange(len(points)), -(points @ q)))[:5]
        assert [i for _, i in best.rows] == order.tolist()
    assert visited < 0.2 * 20 * len(tree.lows[0])  # clustered rows: most leaves are pruned


def test_tiles_are_compact():
    points = np.random.default_rng(2).integers(0, 1000, (4096, 2))
    tiled, plain = (Tree(points[order], 64) for order in (str_order(points, 64), np.arange(4096)))
    area = lambda t: (t.highs[0] - t.lows[0]).prod(axis=1).mean()
    assert area(tiled) < 0.05 * area(plain)
