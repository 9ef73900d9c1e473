"""Exact numbers of links between sets of one component, without a row for each pair.

Sets are told by what they differ in from a pivot of their component. Jaccard distance
is a metric, so sets within half the limit of the pivot, the core, are all linked to
each other, which needs no comparison. The others are compared with all sets of their
component, in blocks of bounded size that are dealt over tasks: of two sets x and y
with differences dx and dy from the pivot, x and y differ in
|dx| + |dy| - 2 |dx and dy| elements.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, unstage

#: Elements of a block's vocabulary that one product of matrices takes.
STRIP = 2048
#: Pairs that are counted one by one at a time.
BATCH = 1 << 22


def overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many elements each array of a shares with each of b; none repeats its own.
    Elements that many arrays hold are counted by products of 0-1 matrices, others by
    the pairs of arrays that hold them."""
    out = np.zeros((len(a), len(b)), np.float32)
    rows = [np.repeat(np.arange(len(x)), [len(y) for y in x]) for x in (a, b)]
    values = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b)]
    common = np.intersect1d(values[0], values[1])
    if not len(common):
        return out
    places = []
    for k in range(2):
        at = np.minimum(np.searchsorted(common, values[k]), len(common) - 1)
        held = np.flatnonzero(common[at] == values[k])
        held = held[np.argsort(at[held], kind="stable")]
        places.append(at[held])
        rows[k] = rows[k][held]
    times = [np.bincount(p, minlength=len(common)) for p in places]
    pairs = times[0] * times[1]
    many = pairs * 64 > out.size
    for at in np.array_split(np.flatnonzero(many), -(-int(many.sum()) // STRIP)) if many.any() else []:
        strip = np.full(len(common), -1)
        strip[at] = np.arange(len(at))
        m = []
        for k in range(2):
            own = strip[places[k]]
            m.append(np.zeros((out.shape[k], len(at)), np.float32))
            m[k][rows[k][own >= 0], own[own >= 0]] = 1
        out += m[0] @ m[1].T
    first = [np.cumsum(t) - t for t in times]
    few = np.flatnonzero(~many)
    for at in np.split(few, np.flatnonzero(np.diff(np.cumsum(pairs[few]) // BATCH)) + 1):
        size = pairs[at]
        which = np.repeat(np.arange(len(at)), size)
        step = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)
        wide = times[1][at][which]
        left = rows[0][first[0][at][which] + step // wide]
        right = rows[1][first[1][at][which] + step % wide]
        out += np.bincount(left * out.shape[1] + right, minlength=out.size).reshape(out.shape)
    return out


def _counting(percent: int):
    """Of blocks of outer sets and of sets of their component: the weight that each
    outer one is linked with, and each core one's links to outer ones."""

    def run(outer: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        key = ["component", "i", "j"]
        blocks, ids, counts = dict(list(members.groupby(key))), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k, x in outer.groupby(key):
            y = blocks.get(k)
            if y is None:
                continue
            dx, dy = list(x["delta"]), list(y["delta"])
            differing = np.array([len(d) for d in dx])[:, None] + np.array([len(d) for d in dy])[None, :] - 2 * overlaps(dx, dy).astype(np.int64)
            total = x["n"].to_numpy()[:, None] + y["n"].to_numpy()[None, :]
            # overlap and union are halves of total - differing and total + differing
            near = (100 * (total - differing) >= percent * (total + differing)) & (x["fp"].to_numpy()[:, None] != y["fp"].to_numpy()[None, :])
            core = y["core"].to_numpy(bool)
            ids += [x["fp"].to_numpy(), y["fp"].to_numpy()[core]]
            counts += [near @ y["w"].to_numpy(), x["w"].to_numpy() @ near[:, core]]
        return pd.DataFrame({"fp": np.concatenate(ids), "k": np.concatenate(counts)})

    return run


def count_links(members: DataFrame, percent: int, block: int = 1024) -> DataFrame:
    """(fp, linked) of members (component, fp, n, w, centre, grams): sets of n grams,
    each once, that stand for w documents each. linked is the number of documents of
    other sets of the component that are similar to the set. The pivot of a component is
    its set of the greatest centre. Sets of components that hold one set are left out."""
    small = staged(members.select("component", "fp", "n", "w", "centre"))
    grams = members.select(F.col("fp").alias("held"), "grams")
    sizes = small.groupBy("component").agg(F.count(F.lit(1)).alias("m"), F.max_by("fp", F.struct("centre", "fp")).alias("pivot")).where("m > 1")
    sizes = staged(sizes.withColumn("salts", F.ceil(F.col("m") / block).cast("long")))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    part = lambda n: F.pmod(F.xxhash64("fp"), F.col(n))
    own = small.join(sizes.select("component", "salts"), "component").withColumn("salt", part("salts"))
    own = own.join(grams, F.col("fp") == F.col("held"))
    pivots = sizes.join(small.select(F.col("fp").alias("pivot"), F.col("n").alias("pivot_n")), "pivot").join(grams.toDF("of", "p"), F.col("pivot") == F.col("of"))
    pivots = pivots.select("component", "pivot_n", "p", every("salts").alias("salt"))
    told = own.join(pivots, ["component", "salt"])
    told = told.select("component", "fp", "n", "w", "pivot_n", F.concat(F.array_except("grams", "p"), F.array_except("p", "grams")).alias("delta"))
    d = F.size("delta")
    told = staged(told.select("component", "fp", "n", "w", "delta", (400 * d <= (100 - percent) * (F.col("n") + F.col("pivot_n") + d)).alias("core")))
    unstage(small, sizes)

    shape = told.groupBy("component").agg(F.count_if(~F.col("core")).alias("outer"), F.count(F.lit(1)).alias("m"), F.sum(F.when(F.col("core"), F.col("w"))).alias("core_w"))
    parts = lambda c: F.ceil(F.col(c) / block).cast("long")
    shape = staged(shape.select("component", "core_w", "outer", parts("outer").alias("is"), parts("m").alias("js"), (F.col("outer") * parts("m") + F.col("m") * parts("outer")).alias("rows")))
    spread = max(1, -(-(shape.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]) // (2 * block)))
    cut = shape.where("outer > 0").select("component", "is", "js")
    slot = F.pmod(F.xxhash64("component", "i", "j"), F.lit(spread)).alias("slot")
    columns = ("component", "i", "j", "fp", "n", "w", "delta")
    left = told.where("NOT core").join(cut, "component").withColumns({"i": part("is"), "j": every("js")})
    right = told.join(cut, "component").withColumns({"j": part("js"), "i": every("is")})
    left = left.select(slot, *columns).toDF("slot", *columns)
    right = right.select(slot, *columns, "core").toDF("slot", *columns, "core")
    met = left.groupBy("slot").cogroup(right.groupBy("slot")).applyInPandas(_counting(percent), "fp long, k long")
    met = met.groupBy("fp").agg(F.sum("k").alias("k"))
    out = told.select("component", "fp", "w", "core").join(shape.select("component", "core_w"), "component").join(met, "fp", "left")
    linked = F.when(F.col("core"), F.col("core_w") - F.col("w")).otherwise(0) + F.coalesce("k", F.lit(0))
    return out.select("fp", linked.alias("linked"))
