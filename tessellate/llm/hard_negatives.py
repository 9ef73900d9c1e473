"""Hard negatives by bounds along spanning trees of anchors.

Anchors are dealt into blocks of near ones, and a spanning tree of least edges joins the
anchors of a block. Candidates are dealt over stripes; each task has one block and one
stripe. The root's inner products with the candidates are worked out. From there a
child's product with a candidate differs from its parent's by at most the length of the
edge times the candidate's norm, so known bounds give bounds for the child, level by
level of the tree. Only candidates whose bounds overlap what the child still looks for are
scored, and from then on their bounds are exact.

What an anchor looks for: first its best rows of its own label, which become positives;
then, for each positive, the best rows of other labels inside a window of its score.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import modest_batches, staged

BLOCK, STRIPE, TILE = 512, 1 << 17, 4096
#: Signs that order anchors, and the number from which a candidate pair is cheaper in a product of matrices.
SIGNS, DENSE = 30, 0.05


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the parent in a spanning tree of least total distance, -1 for the
    root, and the distance to it. Prim's rule, one row at a time."""
    n = len(x)
    parent, edge = np.full(n, -1), np.zeros(n)
    if n < 2:
        return parent, edge
    squares = np.einsum("ij,ij->i", x, x)
    near, via, out = np.full(n, np.inf), np.zeros(n, np.int64), np.ones(n, bool)
    at = 0
    for _ in range(n - 1):
        out[at] = False
        d = squares + squares[at] - 2 * (x @ x[at])
        closer = out & (d < near)
        near[closer], via[closer] = d[closer], at
        at = int(np.flatnonzero(out)[near[out].argmin()])
        parent[at] = via[at]
    joined = parent >= 0
    edge[joined] = np.sqrt(((x[joined] - x[parent[joined]]) ** 2).sum(axis=1))
    return parent, edge


def levels_of(parent: np.ndarray) -> list[np.ndarray]:
    """The rows of each depth of a tree, from the root down."""
    level, out = np.flatnonzero(parent < 0), []
    while len(level):
        out.append(level)
        level = np.flatnonzero(np.isin(parent, level))
    return out


def exact_matrix(vectors: list, most: float) -> np.ndarray:
    """Integral vectors in the plainest type in which a hundredfold of products up to
    `most` is exact, once it is an integer."""
    x = np.vstack(vectors)
    if most < 2.0**53:
        return x.astype(np.float64)
    if most < 2.0**56:
        return x.astype(np.int64)
    return np.array([[int(v) for v in row] for row in x], object).reshape(x.shape)


def tree_scores(anchors: np.ndarray, tile: np.ndarray, tree: tuple, levels: list, slack: float, wanted: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Of each level of the tree: its anchors, the scores of a tile's candidates, and which of
    these are exact, and how many were worked out. wanted says, from a level's anchors and the bounds, which
    candidates may matter; all of these are made exact."""
    parent, edge = tree
    norm = np.sqrt((tile.astype(float) ** 2).sum(axis=1))
    low, high = np.empty((len(anchors), len(tile))), np.empty((len(anchors), len(tile)))
    for level in levels:
        if parent[level[0]] < 0:
            need = np.ones((len(level), len(tile)), bool)
        else:
            reach = edge[level][:, None] * norm[None, :] * (1 + 1e-9) + slack
            low[level] = low[parent[level]] - reach
            high[level] = high[parent[level]] + reach
            need = wanted(level, low[level], high[level])
        if need.mean() > DENSE or anchors.dtype != np.float64:
            scores = anchors[level] @ tile.T
            need = np.ones_like(need)
            low[level] = high[level] = scores
        else:
            i, j = np.nonzero(need)
            scores = np.zeros(need.shape)
            scores[i, j] = np.einsum("ij,ij->i", anchors[level][i], tile[j])
            low[level] = np.where(need, scores, low[level])
            high[level] = np.where(need, scores, high[level])
        yield level, scores, need, int(need.sum())


def _grouped(left: pd.DataFrame, right: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, pd.DataFrame]]:
    keys = ["block", "stripe", "dim"]
    others = dict(list(right.groupby(keys)))
    for k, own in left.groupby(keys):
        if k in others:
            yield own, others[k]


class _Best:
    """The best (score, id) pairs of an anchor's list so far, `most` of them."""

    __slots__ = ("most", "scores", "ids")

    def __init__(self, most: int):
        self.most, self.scores, self.ids = most, [], []

    def floor(self):
        return self.scores[-1] if len(self.scores) == self.most else None

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > 4 * self.most and scores.dtype != object:
            cut = np.partition(scores, len(scores) - self.most)[len(scores) - self.most]
            near = scores >= cut
            scores, ids = scores[near], ids[near]
        both = sorted(zip([*self.scores, *scores.tolist()], [*self.ids, *ids.tolist()], strict=True), key=lambda r: (-r[0], r[1]))[: self.most]
        self.scores, self.ids = [r[0] for r in both], [r[1] for r in both]


def _search(kind: str, most: int, low_pct: int, high_pct: int):
    """One task's part of the positives (kind "same") or of the negatives."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        for own, other in _grouped(left, right):
            _, first = np.unique(other["vec_id"].to_numpy(), return_index=True)
            other = other.iloc[first]
            ids, labels = other["vec_id"].to_numpy(), other["label"].to_numpy()
            a_ids, a_labels = own["vec_id"].to_numpy(), own["label"].to_numpy()
            plain = np.vstack(own["x"]).astype(float)
            size = float(np.sqrt((plain**2).sum(axis=1)).max(initial=0)) * float(other["norm"].max())
            anchors, every = exact_matrix(list(own["x"]), size * 1.01), exact_matrix(list(other["x"]), size * 1.01)
            tree = spanning_tree(plain)
            levels = levels_of(tree[0])
            slack = 1e-6 + 1e-12 * size
            if kind == "same":
                goals = [[(None, None, None, _Best(most))] for _ in a_ids]
            else:
                goals = [[(int(p), low_pct * int(s), high_pct * int(s), _Best(most)) for p, s in zip(ps, ss, strict=True)] for ps, ss in zip(own["positives"], own["scores"], strict=True)]
            floors, ceilings = np.full(len(a_ids), -np.inf), np.full(len(a_ids), np.inf)
            if kind != "same":
                floors = np.array([min((float(lo) / 100 for _, lo, _, _ in g), default=np.inf) for g in goals])
                ceilings = np.array([max((float(hi) / 100 for _, _, hi, _ in g), default=-np.inf) for g in goals])
            for at in range(0, len(ids), TILE):
                tile, t_ids, t_labels = every[at : at + TILE], ids[at : at + TILE], labels[at : at + TILE]

                def fits(level, t_ids=t_ids, t_labels=t_labels):
                    same = a_labels[level][:, None] == t_labels[None, :]
                    return same & (a_ids[level][:, None] != t_ids[None, :]) if kind == "same" else ~same

                def wanted(level, low, high):
                    return fits(level) & (high + slack >= floors[level][:, None]) & (low - slack <= ceilings[level][:, None])

                for level, scores, known, _ in tree_scores(anchors, tile, tree, levels, slack, wanted):
                    near = known & fits(level) & (scores >= floors[level][:, None] - slack) & (scores <= ceilings[level][:, None] + slack)
                    for k in np.flatnonzero(near.any(axis=1)):
                        a = level[k]
                        hit = np.flatnonzero(near[k])
                        s, i = scores[k, hit], t_ids[hit]
                        s = s.astype(np.int64) if s.dtype == np.float64 else s
                        for _, lo, hi, best in goals[a]:
                            inside = slice(None) if lo is None else (100 * s >= lo) & (100 * s <= hi)
                            best.add(s[inside], i[inside])
                        full = [g[3].floor() for g in goals[a]]
                        if None not in full:
                            floors[a] = max(floors[a], float(min(full)))
            for a, g in zip(a_ids.tolist(), goals, strict=True):
                out += [(a, p, int(s), i) for p, _, _, best in g for s, i in zip(best.scores, best.ids, strict=True)]
        f = pd.DataFrame(out, columns=["anchor_id", "positive_id", "score", "found"])
        return f.astype({"anchor_id": "int64", "score": "int64", "found": "int64", "positive_id": "Int64"})

    return run


def _signed(seed: int):
    """A number for each vector whose bits are the signs of products with random directions."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes: dict[int, np.ndarray] = {}
        for f in frames:
            near = np.zeros(len(f), np.int64)
            for dim, rows in f.groupby("dim").indices.items():
                if dim and dim not in planes:
                    planes[dim] = np.random.default_rng([seed, dim]).standard_normal((dim, SIGNS))
                if dim:
                    near[rows] = ((np.vstack(f["x"].to_numpy()[rows]).astype(float) @ planes[dim]) > 0) @ (1 << np.arange(SIGNS)[::-1])
            yield f.assign(near=near)

    return run


def _ranked(df: DataFrame, by: list[str], most: int) -> DataFrame:
    spec = Window.partitionBy(*by).orderBy(F.desc("score"), "found")
    return df.withColumn("rank", F.row_number().over(spec)).where(F.col("rank") <= most)


def quantized(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, x, dim, norm) of the rows of vectors (vec_id, embedding, label) that
    take part: floor(256 x) of each component; labels of every seventh vec_id are one
    further, modulo ten. Of rows with one vec_id, the least (label, vector) stands for all."""
    v = F.col("embedding").cast("array<double>")
    whole = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & whole)
    label = F.col("label").cast("long")
    turned = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.struct(turned.alias("label"), v.alias("v")).alias("row"))
    one = rows.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.v")
    # doubles keep whole numbers that longs can't hold
    x = F.transform("v", lambda c: F.when(F.abs(c) < 1e15, F.floor(256 * c).cast("double")).otherwise(256 * c))
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, c: s + c * c))
    return one.select("vec_id", "label", x.alias("x")).withColumns({"dim": F.size("x"), "norm": norm})


def hard_negatives(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low_pct: int = 30, high_pct: int = 90, block: int = BLOCK, stripe: int = STRIPE, seed: int = 3) -> DataFrame:
    """For each anchor (a row of vectors whose vec_id is divisible by `every`) and each
    of its positives (its best `positives` other rows of the same label), the first
    `negatives` rows of other labels with low_pct * positive_score <= 100 * score <= high_pct *
    positive_score: anchor_id, positive_id, rank (from 1), negative_id, positive_score,
    negative_score. Scores are exact integers; higher ones come first, then smaller ids.

    Rows with a null vec_id, label or vector, or with a null or non-finite component,
    take no part. Of rows that share a vec_id the least (label, vector) stands for all.
    Vectors of different lengths have no product. An anchor without positives, and a
    positive without negatives in its window (any of a negative score), give no rows.
    An empty table gives an empty result; other columns, whatever their names, are
    ignored. Products must fit a long, else the task fails. Anchors are searched in blocks of about
    `block`, and candidates in stripes of about `stripe`, so a task's memory is bounded
    by the two; each stripe gives at most the wanted number of rows for each list."""
    modest_batches(vectors.sparkSession)
    rows = staged(quantized(vectors))
    total = rows.count()
    stripes = max(1, -(-total // stripe))
    anchors = rows.where(F.col("vec_id") % every == 0).mapInPandas(_signed(seed), "vec_id long, label long, x array<double>, dim int, norm double, near long")
    anchors = staged(anchors)
    n = anchors.count()
    parts = max(1, -(-n // block))
    # ranges of like signs, cut by hash where more anchors than a block are alike
    cuts = sorted(set(anchors.approxQuantile("near", [k / parts for k in range(1, parts)], 0.2 / parts))) if parts > 1 else []
    bounds = F.from_json(F.lit(str([int(c) for c in cuts])), "array<bigint>")
    anchors = anchors.withColumn("range", F.size(F.filter(bounds, lambda c: c <= F.col("near"))))
    counts = F.broadcast(anchors.groupBy("range").agg(F.ceil(F.count(F.lit(1)) / block).cast("long").alias("splits")))
    anchors = anchors.join(counts, "range").withColumn("block", F.col("range") * 1000003 + F.pmod(F.xxhash64("vec_id"), F.col("splits")))
    anchors = staged(anchors.select("block", "vec_id", "label", "x", "dim"))
    blocks = anchors.select("block", "dim").distinct()
    dealt = rows.withColumn("stripe", F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(stripes)))
    # a stated query set against all rows, in blocks: each stripe once for each block
    candidates = dealt.join(F.broadcast(blocks), "dim").select("block", "stripe", "dim", "vec_id", "label", "x", "norm")
    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(stripes - 1).cast("long"))).alias("stripe")
    shape = "anchor_id long, positive_id long, score long, found long"

    def met(left: DataFrame, kind: str, most: int) -> DataFrame:
        left, right = left.toDF(*left.columns), candidates.toDF(*candidates.columns)  # columns of their own
        both = left.groupBy("block", "stripe").cogroup(right.groupBy("block", "stripe"))
        return both.applyInPandas(_search(kind, most, low_pct, high_pct), shape)

    own = anchors.select("block", everywhere, "vec_id", "label", "x", "dim")
    best = staged(_ranked(met(own, "same", positives), ["anchor_id"], positives))
    lists = best.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_list(F.struct("rank", "found", "score"))).alias("p"))
    asked = anchors.join(lists, "vec_id").select("block", "vec_id", "label", "x", "dim", F.col("p.found").alias("positives"), F.col("p.score").alias("scores"))
    asked = staged(asked).select("block", everywhere, "vec_id", "label", "x", "dim", "positives", "scores")
    found = _ranked(met(asked, "other", negatives), ["anchor_id", "positive_id"], negatives)
    scores = best.select("anchor_id", F.col("found").alias("positive_id"), F.col("score").alias("positive_score"))
    out = found.join(scores, ["anchor_id", "positive_id"])
    return out.select("anchor_id", "positive_id", "rank", F.col("found").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
