"""Hard negatives against all products, and the bounds along trees."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from tessellate.llm.hard_negatives import hard_negatives, levels_of, spanning_tree, tree_scores

COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def plain(rows, every=100, positives=5, negatives=10):
    own = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        own[i] = min(own.get(i, (label, v)), (label, v))
    own = {i: (label, [math.floor(256 * c) for c in v]) for i, (label, v) in own.items()}
    out = []
    for a, (label, v) in own.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i, other) for i, (other, w) in own.items() if i != a and len(w) == len(v))
        for s, p, _ in [r for r in scored if r[2] == label][:positives]:
            window = [r for r in scored if r[2] != label and 30 * -s <= 100 * -r[0] <= 90 * -s][:negatives]
            out += [(a, p, k + 1, i, -s, -t) for k, (t, i, _) in enumerate(window)]
    return sorted(out)


def got(df, **kw):
    return sorted(map(tuple, hard_negatives(df, **kw).select(*COLUMNS).collect()))


SHAPE = "vec_id long, embedding array<double>, label int"


def test_clusters_and_ties(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((6, 8))
    rows = [(i, [float(x) for x in np.round(centres[i % 6] + 0.1 * rng.standard_normal(8), 1)], int(rng.integers(0, 4))) for i in range(600)]
    rows += [(1000 + i, rows[0][1], i % 3) for i in range(200)]  # a group of copies, with anchors among them
    want = plain(rows, every=20)
    assert len(want) > 500
    df = spark.createDataFrame(rows, SHAPE)
    for kw in ({}, {"block": 4, "stripe": 90}):
        assert got(df, every=20, **kw) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (0, [0.5, 0.5], 1), (0, [1.0, 0.5], 1), (None, [1.0, 1.0], 1), (1, None, 1), (2, [1.0, 1.0], None), (3, [nan, 1.0], 1), (4, [None, 1.0], 1), (5, [inf, 1.0], 2), (6, [1.0, 1.0], 1), (7, [0.3, 0.3], 0), (8, [0.4, 0.4], 2), (9, [0.4, 0.4], 2), (100, [1.0], 3), (200, [0.0, 0.0], 1), (300, [], 1), (301, [], 1), (-100, [-1.0, 2.0], 1), (11, [0.3], 4), (12, [0.2, 0.1], -5)]
    df = spark.createDataFrame(rows, SHAPE).select("*", *[F.lit(1).alias(c) for c in ("block", "stripe", "score", "rank", "norm", "dim", "near", "x")])
    want = plain(rows)
    assert want and got(df) == want
    assert got(df.limit(0)) == [] and hard_negatives(df).columns == list(COLUMNS)


@pytest.mark.parametrize("scale", [1e5, 1e6, 3e6])
def test_large_components_are_exact(spark, scale):
    """Products beyond 53 bits, where doubles would round."""
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in scale * rng.uniform(0.4, 1, 3)], i % 2) for i in range(40)]
    assert got(spark.createDataFrame(rows, SHAPE), every=10) == plain(rows, every=10)


def test_bounds_spare_scores():
    rng = np.random.default_rng(4)
    anchors = np.floor(256 * np.repeat(rng.standard_normal((3, 16)), 30, axis=0) + rng.integers(-3, 4, (90, 16)))
    tile = np.floor(256 * rng.standard_normal((500, 16)))
    parent, edge = spanning_tree(anchors)
    assert (parent < 0).sum() == 1 and np.allclose(edge[1:] ** 2, ((anchors - anchors[parent]) ** 2).sum(axis=1)[1:])
    levels, exact, made = levels_of(parent), anchors @ tile.T, 0
    assert sorted(np.concatenate(levels).tolist()) == list(range(90))
    least = np.quantile(exact, 0.99)
    for level, scores, known, n in tree_scores(anchors, tile, (parent, edge), levels, 1e-6, lambda _, low, high: high >= least):
        made += n
        assert (scores[known] == exact[level][known]).all()
        assert not (exact[level][~known] >= least).any()
    assert made < 0.4 * exact.size
