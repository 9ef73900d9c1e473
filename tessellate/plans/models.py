"""Queries around a trained model (M); numbers depend on the trainer, so that they
have no SQL to compare with and are tested by their properties."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import diagnostics as D
from ..operators import model as T
from ..operators import ranks as G
from .base import calendar, query
from .metrics import FEATURES, _root, frame

SETS = {"all": FEATURES, "returns": ("f_ret",), "activity": ("f_vol", "f_amount")}


def split(spark, sf):
    f = frame(spark, sf).withColumn("y", F.greatest(F.least("y", F.lit(1.0)), F.lit(-1.0)))
    f = f.withColumn("y", F.when(F.col("by_").isNotNull(), F.col("y")))
    cut = F.to_date(F.lit("1998-01-01"))
    return f.where(F.col("session") < cut), f.where(F.col("session") >= cut)


@query("m01_scored")
def scored(spark, sf):
    train, test = split(spark, sf)
    return G.ranked(T.fit_scores(train, FEATURES)(test).select("entity", "session", "score"), "score")


@query("m02_m04_scorecards")
def scorecards(spark, sf):
    train, test = split(spark, sf)
    return T.compare_sets(train, test, calendar(spark, sf), SETS, trees=5)


@query("m04_blended_order")
def blended(spark, sf):
    train, _ = split(spark, sf)
    model = T.fit_trees(train, FEATURES, trees=5)
    gains = T.split_importance(T.split_table(spark, model, FEATURES, _root(spark, "trees")), FEATURES)
    ic = D.daily_ic(D.long_form(train, ["entity", "session", "y"], FEATURES))
    cover = D.long_form(train, ["entity", "session"], FEATURES).groupBy("feature").agg(F.avg(F.col("x").isNotNull().cast("double")).alias("coverage"))
    summary = D.stability_score(D.summarize_ic(ic), D.summarize_ic(ic.withColumn("year", F.year("session")), ["feature", "year"]), cover)
    return T.blended_order(summary, gains)


@query("m03_importance")
def importance(spark, sf):
    train, test = split(spark, sf)
    return T.permutation_importance(test, T.fit_scores(train, FEATURES, trees=5), FEATURES)
