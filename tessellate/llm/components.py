"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, unstage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest of its neighbourhood."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours, and itself, to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) of every node of edges (u, v); the component is its smallest
    node. Each round is written to the shared folder and read again; the table of
    links shrinks to a star for each component in a number of rounds that grows
    with the logarithm of its size. Fails if that takes more than `rounds`."""
    now = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = _mark(now)
    if not mark[0]:
        return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    for _ in range(rounds):
        after = staged(_small_star(_large_star(now)))
        unstage(now)
        now, before, mark = after, mark, _mark(after)
        if mark == before:
            roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
    raise RuntimeError("the components have not settled")
