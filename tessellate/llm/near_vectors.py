"""Near duplicates among vectors, by sorted projection passes.

In each pass a vector's key is the string of the signs of its products with fresh
random directions. Vectors are sorted by key, and each is compared, by its cosine in
double precision, with the next `window` ones. The verified pairs of all passes make
components. There are as many passes as a stated recall needs at the table's size: two
vectors at the limit stand within a window if they agree in the signs that tell a
window's rows from the rest, and passes are independent.

Within a component, links are then counted in full. All vectors within half the limit
angle of the component's root are linked to each other, which needs no comparison. For
the others the component is divided into cells around a square root's number of its
vectors; by the triangle inequality, only cells whose distance is at most their radii
and the limit angle together are compared, in blocks of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import modest_batches, staged
from .components import components

BITS = 48


def _usable(v: str) -> Column:
    whole = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(v).isNotNull() & (F.size(v) > 0) & whole & F.exists(v, lambda x: x != 0)


def passes_for(n: int, limit: float, window: int, recall: float) -> int:
    """How many passes find a pair at the limit with a probability of recall: a sign
    differs with the angle over pi, and log2(n / window) signs must agree."""
    signs = max(1.0, math.log2(max(2.0, n / window)))
    met = (1 - math.acos(limit) / math.pi) ** signs
    return max(4, math.ceil(math.log(1 - recall) / math.log1p(-met)))


def _keys(passes: int, seed: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(BITS, dtype=np.int64)
        for f in frames:
            for dim, own in f.groupby("dim"):
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, dim]).standard_normal((dim, passes * BITS))
                signs = (np.vstack(own["v"]).astype(float) @ planes[dim]) > 0
                keys = signs.reshape(len(own), passes, BITS) @ weights
                yield pd.DataFrame({"vec_id": own["vec_id"].to_numpy(), "dim": dim, "keys": list(keys)})

    return run


def _windows(limit: float, window: int, size: int = 1024):
    """Links between vectors of a pass that stand at most window places apart, as many
    as make the batch's components."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for f in frames:
            root: dict[int, int] = {}

            def find(n: int, root: dict[int, int] = root) -> int:
                while root.setdefault(n, n) != n:
                    root[n] = root[root[n]]
                    n = root[n]
                return n

            for at in range(0, len(f), size):
                fresh = f.iloc[at : at + size]
                old = 0 if held is None else len(held)
                both = fresh if held is None else pd.concat([held, fresh], ignore_index=True)
                held = both.iloc[-window:]
                place = np.arange(len(both))
                for _, rows in both.groupby(["dim", "pass"], sort=False).indices.items():
                    x = np.vstack(both["v"].to_numpy()[rows]).astype(float)
                    x /= np.linalg.norm(x, axis=1, keepdims=True)
                    later = np.flatnonzero(rows >= old)
                    if not len(later):
                        continue
                    step = place[rows][later][None, :] - place[rows][:, None]
                    i, j = np.nonzero((x @ x[later].T >= limit) & (step > 0) & (step <= window))
                    ids = both["vec_id"].to_numpy()[rows]
                    for u, v in zip(ids[i].tolist(), ids[later[j]].tolist(), strict=True):
                        u, v = find(u), find(v)
                        root[max(u, v)] = min(u, v)
            yield pd.DataFrame([(n, find(n)) for n in list(root) if root[n] != n], columns=["u", "v"], dtype="int64")

    return run


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _nearest():
    """The pivot of its component that each member is nearest to, and the angle."""

    def run(members: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        out = []
        centres = dict(list(pivots.groupby("component")))
        for component, own in members.groupby("component"):
            p = centres[component]
            cosines = np.vstack(own["x"]) @ np.vstack(p["x"]).T
            best = cosines.argmax(axis=1)
            angle = np.arccos(np.clip(cosines[np.arange(len(own)), best], -1, 1))
            out.append(pd.DataFrame({"vec_id": own["vec_id"].to_numpy(), "component": component, "cell": p["vec_id"].to_numpy()[best], "angle": angle, "core": own["core"].to_numpy(), "x": own["x"].to_numpy()}))
        return pd.concat(out) if out else pd.DataFrame(columns=["vec_id", "component", "cell", "angle", "core", "x"])

    return run


def _counting(limit: float):
    """Of blocks of outer members and members of a near cell: what each outer one is
    linked with, and each core one's links to outer ones."""

    def run(outer: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        key = ["component", "p", "q", "i", "j"]
        blocks, ids, counts = dict(list(members.groupby(key))), [], []
        for k, own in outer.groupby(key):
            other = blocks.get(k)
            if other is None:
                continue
            a, b = own["vec_id"].to_numpy(), other["vec_id"].to_numpy()
            near = (np.vstack(own["x"]) @ np.vstack(other["x"]).T >= limit) & (a[:, None] != b[None, :])
            core = other["core"].to_numpy(bool)
            ids += [a, b[core]]
            counts += [near.sum(axis=1), near[:, core].sum(axis=0)]
        return pd.DataFrame({"vec_id": np.concatenate(ids) if ids else np.zeros(0, np.int64), "k": np.concatenate(counts).astype(np.int64) if ids else np.zeros(0, np.int64)})

    return run


def _outer_links(members: DataFrame, limit: float, block: int) -> DataFrame:
    """(vec_id, k): links of members that aren't core, and of core ones with those. Of
    members (vec_id, component, x, core), those of components with any outer ones."""
    wanted = members.where("NOT core").select("component").distinct()
    sizes = members.join(wanted, "component", "left_semi").groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    sizes = staged(sizes.withColumns({"m": F.ceil(F.sqrt("n")).cast("long"), "salts": F.ceil(F.col("n") / block).cast("long")}))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    slots = max(1, -(-total // block))
    own = members.join(sizes, "component").withColumn("slot", F.pmod(F.xxhash64("component"), F.lit(slots)))
    chosen = own.where((F.pmod(F.xxhash64("vec_id", F.lit(7)), F.col("n")) < F.col("m")) | (F.col("vec_id") == F.col("component")))
    pivots = chosen.select("slot", "component", "vec_id", "x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))
    pivots = pivots.toDF(*pivots.columns)  # columns of its own, for the cogroup
    dealt = own.select("slot", "component", "vec_id", "x", "core", F.pmod(F.xxhash64("vec_id"), F.col("salts")).alias("salt"))
    placed = dealt.groupBy("slot", "salt").cogroup(pivots.groupBy("slot", "salt")).applyInPandas(_nearest(), "vec_id long, component long, cell long, angle double, core boolean, x array<double>")
    placed = staged(placed)
    cells = placed.groupBy("component", "cell").agg(F.max("angle").alias("r"), F.count(F.lit(1)).alias("k"), F.max(F.when(~F.col("core"), F.col("angle"))).alias("outer_r"), F.count_if(~F.col("core")).alias("outer_k"))
    cells = staged(cells.join(members.select(F.col("vec_id").alias("cell"), F.col("x").alias("c")), "cell"))
    p, q = [cells.select("component", *[F.col(c).alias(f"{side}_{c}") for c in ("cell", "r", "k", "outer_r", "outer_k", "c")]) for side in ("p", "q")]
    apart = F.acos(F.greatest(F.least(_dot("p_c", "q_c"), F.lit(1.0)), F.lit(-1.0)))
    pairs = p.where("p_outer_k > 0").join(q, "component").where(apart <= F.col("p_outer_r") + F.col("q_r") + math.acos(limit) + 1e-9)
    parts = lambda c: F.ceil(F.col(c) / block).cast("long")
    pairs = staged(pairs.select("component", F.col("p_cell").alias("p"), F.col("q_cell").alias("q"), parts("p_outer_k").alias("is"), parts("q_k").alias("js"), (F.col("p_outer_k") * parts("q_k") + F.col("q_k") * parts("p_outer_k")).alias("rows")))
    spread = max(1, -(-(pairs.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]) // block))
    slot = F.pmod(F.xxhash64("component", "p", "q", "i", "j"), F.lit(spread)).alias("slot")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    part = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n))
    left = placed.where("NOT core").withColumnRenamed("cell", "p").join(pairs, ["component", "p"]).withColumns({"i": part("is"), "j": every("js")})
    right = placed.withColumnRenamed("cell", "q").join(pairs, ["component", "q"]).withColumns({"j": part("js"), "i": every("is")})
    columns = ("component", "p", "q", "i", "j", "vec_id", "x")
    right = right.select(slot, *columns, "core").toDF("slot", *columns, "core")
    both = left.select(slot, *columns).groupBy("slot").cogroup(right.groupBy("slot"))
    return both.applyInPandas(_counting(limit), "vec_id long, k long").groupBy("vec_id").agg(F.sum("k").alias("k"))


def near_vectors(vectors: DataFrame, limit: float = 0.9, window: int = 256, recall: float = 0.99, passes: int | None = None, seed: int = 5, block: int = 4096) -> DataFrame:
    """A row for each row of vectors (vec_id, embedding): vec_id, n_links (the other
    vectors linked to it), component_id (the smallest vec_id that links lead to) and
    kept (whether that is its own).

    recall is the chance that a lone pair at the limit is found, from which the number
    of passes follows unless given; nearer pairs, and those that others connect, are
    found more surely. Links that no pass finds and that cross components are missed.

    A vector that is null, empty or zero or holds a null or non-finite number links
    with nothing, nor do vectors of different lengths with each other. Of rows that
    share a vec_id, the least vector stands for all. A row without vec_id has no
    links and no component, and is kept. An empty table gives an empty result; other
    columns, whatever their names, are ignored."""
    modest_batches(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    good = rows.where(F.col("vec_id").isNotNull() & _usable("v")).groupBy("vec_id").agg(F.min("v").alias("v"))
    most = F.array_max(F.transform("v", lambda x: F.abs(x)))
    good = staged(good.select("vec_id", F.size("v").alias("dim"), F.transform("v", lambda x: x / most).alias("v")))
    passes = passes or passes_for(good.count(), limit, window, recall)
    keyed = good.mapInPandas(_keys(passes, seed), "vec_id long, dim int, keys array<long>")
    slots = keyed.select("vec_id", "dim", F.posexplode("keys").alias("pass", "key"))
    parts = max(8, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = slots.join(good.select("vec_id", "v"), "vec_id")
    ordered = ordered.repartitionByRange(parts, "dim", "pass", "key", "vec_id").sortWithinPartitions("dim", "pass", "key", "vec_id")
    edges = ordered.select("vec_id", "dim", "pass", "v").mapInPandas(_windows(limit, window), "u long, v long")
    found = components(edges)

    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    unit = good.select("vec_id", F.transform("v", lambda x: x / length).alias("x"))
    members = found.withColumnRenamed("node", "vec_id").join(unit, "vec_id")
    pivots = unit.select(F.col("vec_id").alias("component"), F.col("x").alias("p"))
    core = _dot("x", "p") >= math.sqrt((1 + limit) / 2) + 1e-9
    members = staged(members.join(pivots, "component").select("vec_id", "component", "x", core.alias("core")))
    cores = members.where("core").groupBy("component").agg(F.count(F.lit(1)).alias("c"))
    ends = _outer_links(members, limit, block)
    counted = members.select("vec_id", "component", "core").join(cores, "component", "left").join(ends, "vec_id", "left")
    n_links = F.when(F.col("core"), F.col("c") - 1).otherwise(0) + F.coalesce("k", F.lit(0))
    counted = counted.select(F.col("vec_id").alias("id"), "component", n_links.alias("n_links"))
    out = rows.select("vec_id", _usable("v").alias("usable")).join(counted, (F.col("vec_id") == F.col("id")) & F.col("usable"), "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
