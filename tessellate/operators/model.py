"""A tree regressor on the panel, its scorecard, and importances by permutation.

The trainer is Spark's own; what is built here is the data work around it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import avg_rank_pct
from .diagnostics import daily_ic, path_metrics, set_turnover, summarize_ic
from .ranks import top_fraction


def vectors(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Missing features become 0 beside a flag of their own."""
    from pyspark.ml.functions import array_to_vector

    filled = [F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features]
    flags = [F.col(f).isNull().cast("double") for f in features]
    return df.withColumn("features", array_to_vector(F.array(*filled, *flags)))


def fit_trees(train: DataFrame, features: Sequence[str], trees: int = 10, depth: int = 3, seed: int = 7):
    """M1: boosted trees for y."""
    from pyspark.ml.regression import GBTRegressor

    rows = vectors(train.where("y IS NOT NULL"), features).select("features", F.col("y").alias("label"))
    return GBTRegressor(maxIter=trees, maxDepth=depth, seed=seed).fit(rows)


def fit_scores(train: DataFrame, features: Sequence[str], trees: int = 10, depth: int = 3, seed: int = 7):
    """M1: boosted trees for y; returns a function that adds `score`."""
    model = fit_trees(train, features, trees, depth, seed)
    return lambda df: model.transform(vectors(df, features)).withColumnRenamed("prediction", "score").drop("features")


def split_table(spark: SparkSession, model, features: Sequence[str], path: str) -> DataFrame:
    """M4: a row for each split of the fitted trees: tree, node, feature, gain (the impurity it
    takes away, over the rows that pass it) and rows. The model is saved to path, a folder that all executors
    share, and its nodes are read as the table that they are; a split on a feature's
    missing flag is one on the feature."""
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").where("leftChild >= 0")
    name = F.get(F.array(*[F.lit(f) for f in features]), (F.col("split.featureIndex") % len(features)).cast("int"))
    return nodes.select(F.col("treeID").alias("tree"), F.col("id").alias("node"), name.alias("feature"), (F.col("gain") * F.col("rawCount")).alias("gain"), F.col("rawCount").alias("rows"))


def split_importance(splits: DataFrame, features: Sequence[str]) -> DataFrame:
    """M4: (feature, gain_importance, split_importance), the sum of gains and the number of splits;
    0 for features that no tree uses."""
    every = splits.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    used = splits.groupBy("feature").agg(F.sum("gain").alias("gain_importance"), F.count(F.lit(1)).alias("split_importance"))
    return every.join(used, "feature", "left").fillna({"gain_importance": 0.0, "split_importance": 0})


def blended_order(summary: DataFrame, importance: DataFrame) -> DataFrame:
    """M4: features by the mean of their percentile ranks (ties averaged) in robust_score,
    gain_importance and split_importance, those that are known; best first, ties by name:
    feature, ic_rank, gain_rank, split_rank, ordering_score, place."""
    ranks = {"ic_rank": "robust_score", "gain_rank": "gain_importance", "split_rank": "split_importance"}
    both = summary.select("feature", "robust_score").join(importance.select("feature", "gain_importance", "split_importance"), "feature", "left").withColumn("_all", F.lit(1))
    both = both.withColumns({r: avg_rank_pct(c, ["_all"]) for r, c in ranks.items()})
    known = sum((F.col(r).isNotNull().cast("int") for r in ranks), F.lit(0))
    mean = sum((F.coalesce(F.col(r), F.lit(0.0)) for r in ranks), F.lit(0.0)) / F.when(known > 0, known)
    both = both.withColumn("ordering_score", mean)
    place = F.row_number().over(Window.partitionBy("_all").orderBy(F.col("ordering_score").desc_nulls_last(), "feature"))
    return both.select("feature", *ranks, "ordering_score", place.alias("place"))


def top_sets(ordered: Sequence[str], counts: Sequence[int]) -> dict[str, list[str]]:
    """M4: the first n features for each count below their number, and all of them."""
    ordered = list(ordered)
    return {f"top_{n}": ordered[:n] for n in sorted(set(counts)) if n < len(ordered)} | {"all_accepted": ordered}


def scorecard(scored: DataFrame, cal: DataFrame, fraction: float = 0.1, periods: float = 52.0) -> DataFrame:
    """M2: one row: rank IC and its ratio, the top fraction's path, its turnover, and
    the share of years with a positive IC."""
    ic = daily_ic(scored.withColumn("x", F.col("score")), ["session"], 3).withColumn("model", F.lit("model"))
    one = summarize_ic(ic, ["model"])
    years = ic.groupBy(F.year("session").alias("year")).agg(F.avg("rank_ic").alias("m")).agg(F.avg((F.col("m") > 0).cast("double")).alias("positive_years"))
    top = top_fraction(scored, "score", fraction)
    path = path_metrics(top.groupBy("session").agg(F.avg("y").alias("ret")).withColumn("model", F.lit("model")), ["model"], "session", "ret", periods).select("model", "sharpe", "max_drawdown")
    turn = set_turnover(top.select("session", "entity"), cal).agg(F.avg("turnover").alias("turnover"))
    return one.join(path, "model").crossJoin(F.broadcast(years)).crossJoin(F.broadcast(turn)).drop("model")


def shuffled(df: DataFrame, feature: str, seed: int = 1) -> DataFrame:
    """M3: a feature's values dealt anew within each session, by pairing the rows'
    order with a seeded hash order; the same rows always get the same values."""
    w = Window.partitionBy("session")
    deal = F.xxhash64(F.lit(seed), F.lit(feature), "entity")
    own = df.withColumn("_n", F.row_number().over(w.orderBy("entity")))
    other = df.select("session", F.col(feature).alias("_x"), F.row_number().over(w.orderBy(deal, "entity")).alias("_n"))
    return own.drop(feature).join(other, ["session", "_n"]).withColumnRenamed("_x", feature).drop("_n")


def permutation_importance(df: DataFrame, score, features: Sequence[str], seed: int = 1) -> DataFrame:
    """M3: how much the mean rank IC falls when a feature is shuffled."""
    ic = lambda rows: daily_ic(score(rows).withColumn("x", F.col("score")), ["session"], 3).agg(F.avg("rank_ic").alias("ic"))
    base = ic(df).withColumnRenamed("ic", "base")
    out = None
    for f in features:
        one = ic(shuffled(df, f, seed)).select(F.lit(f).alias("feature"), "ic")
        out = one if out is None else out.unionByName(one)
    return out.crossJoin(F.broadcast(base)).select("feature", (F.col("base") - F.col("ic")).alias("importance"))


def compare_sets(train: DataFrame, test: DataFrame, cal: DataFrame, sets: Mapping[str, Sequence[str]], **settings) -> DataFrame:
    """M4: a scorecard for each named set of features, as in ablations."""
    out = None
    for name, features in sets.items():
        one = scorecard(fit_scores(train, features, **settings)(test), cal).withColumn("feature_set", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out
