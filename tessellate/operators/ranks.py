"""Ranks, percentiles and selections within a session."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import avg_rank_pct, bucketize, col


def ranked(df: DataFrame, score: str, by: Sequence[str] = ("session",), tie: str = "entity") -> DataFrame:
    """Rank by score (ties by key), the group's size, and 1 - (rank - 1) / n."""
    spec = Window.partitionBy(*by).orderBy(F.col(score).desc_nulls_last(), tie)
    out = df.withColumn("rank", F.row_number().over(spec)).withColumn("cross_section_size", F.count(F.lit(1)).over(Window.partitionBy(*by)))
    return out.withColumn("score_percentile", 1 - (F.col("rank") - 1) / F.col("cross_section_size"))


def percentiles(df: DataFrame, x: str, by: Sequence[str], out: str, eligible: Column | None = None) -> DataFrame:
    """Tie-averaged percentiles within any group."""
    return df.withColumn(out, avg_rank_pct(x, by, eligible))


def large_groups(df: DataFrame, by: Sequence[str], least: int) -> DataFrame:
    """The rows of groups of at least so many."""
    return df.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*by))).where(F.col("_n") >= least).drop("_n")


def top_fraction(df: DataFrame, score: str, fraction: float, by: Sequence[str] = ("session",), tie: str = "entity") -> DataFrame:
    """The best max(1, ceil(n * fraction)) rows of each group."""
    both = ranked(df, score, by, tie)
    return both.where(F.col("rank") <= F.greatest(F.lit(1), F.ceil(F.col("cross_section_size") * fraction)))


def entry_lists(df: DataFrame, cal: DataFrame, score: str, n: int) -> DataFrame:
    """The best n of each session under the next session, when they are entered."""
    top = ranked(df, score).where(F.col("rank") <= n)
    nxt = cal.select("session", F.lead("session").over(Window.orderBy("session")).alias("entry_session"))
    return top.join(F.broadcast(nxt), "session").where("entry_session IS NOT NULL").select("entry_session", "session", "entity", "rank")


def outlook(p: Column | str, cuts: Sequence[tuple[float, str]], lowest: str) -> Column:
    """The label of the highest cut that p reaches."""
    out = F.lit(lowest)
    for least, label in sorted(cuts):
        out = F.when(col(p) >= least, F.lit(label)).otherwise(out)
    return F.when(col(p).isNotNull(), out)


def ensemble(scores: DataFrame, models: int, parts: int | None = None) -> DataFrame:
    """Of long scores (model_id, session, entity, score): the mean of each
    model's percentiles, for keys that all models have, ranked anew. parts is into how many
    parts sessions are dealt; without it Spark's setting holds, at any size."""
    scores = scores.repartition(parts, "model_id", "session") if parts else scores
    pct = scores.withColumn("p", avg_rank_pct("score", ["model_id", "session"]))
    both = pct.groupBy("session", "entity").agg(F.avg("p").alias("score"), F.count("p").alias("n")).where(F.col("n") == models).drop("n")
    return ranked(both.repartition(parts, "session") if parts else both, "score")


def history_percentile(values: DataFrame, key: str, order: str, x: str) -> DataFrame:
    """Adds `history_pct`, the share of a key's earlier values that are at most
    the row's; (key, order) is unique.

    Rows are numbered in order. For each power of two, the rows of a key fall into
    pairs of neighbouring blocks of that length, and every earlier row stands in the
    first block of exactly one pair whose second block holds the row. So a row looks at
    about log2(n) running counts, and nothing holds a key's history."""
    numbered = values.withColumn("_i", F.row_number().over(Window.partitionBy(key).orderBy(order)) - 1)
    numbered = numbered.withColumn("_n", F.max("_i").over(Window.partitionBy(key)))
    levels = F.sequence(F.lit(0), F.greatest(F.ceil(F.log2(F.col("_n") + F.lit(1.0))).cast("int"), F.lit(1)) - 1)
    each = numbered.select(key, F.col("_i"), F.col(x).alias("_x"), F.explode(levels).alias("_k"))
    block = F.floor(F.col("_i") / F.pow(F.lit(2.0), F.col("_k"))).cast("long")
    each = each.withColumns({"_pair": F.shiftright(block, 1), "_second": block.bitwiseAND(F.lit(1))})
    # values of the first block come before equal ones of the second
    run = Window.partitionBy(key, "_k", "_pair").orderBy("_x", "_second").rowsBetween(Window.unboundedPreceding, 0)
    below = each.withColumn("_c", F.sum(1 - F.col("_second")).over(run)).where("_second = 1").groupBy(key, "_i").agg(F.sum("_c").alias("_below"))
    out = numbered.join(below, [key, "_i"], "left")
    return out.withColumn("history_pct", F.when(F.col("_i") > 0, F.coalesce("_below", F.lit(0)) / F.col("_i"))).drop("_i", "_n", "_below")


def top_lists(df: DataFrame, score: str, sizes: Sequence[int], by: Sequence[str] = ("session",)) -> DataFrame:
    """The best k rows for each list size k."""
    listed = ranked(df, score, by).withColumn("list_size", F.explode(F.array(*[F.lit(k) for k in sizes])))
    return listed.where(F.col("rank") <= F.col("list_size"))


def bucketed(df: DataFrame, p: str, n: int) -> DataFrame:
    """The buckets of p by each of the four rules."""
    return df.withColumns({f"bucket_{rule}": bucketize(p, n, rule) for rule in ("floor", "floor_open", "ceil", "decile")})
