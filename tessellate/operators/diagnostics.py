"""Information coefficients, score layers and ranking metrics.

Inputs are long tables of (session, entity, feature or model, value x, target y)."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import avg_rank, avg_rank_pct, bucketize, corr_of
from .ranks import ranked


def long_form(df: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """One row per key and feature, in one pass."""
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in features]))
    return df.select(*keys, each.alias("_f")).select(*keys, "_f.feature", "_f.x")


def daily_ic(rows: DataFrame, by: Sequence[str] = ("session", "feature"), least: int = 5) -> DataFrame:
    """Pearson and rank correlation of x and y per group, over the rows that have
    both; ranks are taken among those. Groups of fewer than `least` are left out."""
    both = rows.where(F.col("x").isNotNull() & F.col("y").isNotNull())
    both = both.withColumns({"_rx": avg_rank("x", by), "_ry": avg_rank("y", by)})
    out = both.groupBy(*by).agg(corr_of("x", "y").alias("ic"), corr_of("_rx", "_ry").alias("rank_ic"), F.count(F.lit(1)).alias("n"))
    return out.where(F.col("n") >= least)


def summarize_ic(ic: DataFrame, by: Sequence[str] = ("feature",)) -> DataFrame:
    """Mean, deviation, their ratio and the share of positive days; by
    year or regime if those are among the keys."""
    out = ic.groupBy(*by).agg(F.avg("rank_ic").alias("ic_mean"), F.stddev_samp("rank_ic").alias("ic_std"), F.avg((F.col("rank_ic") > 0).cast("double")).alias("positive_ratio"), F.count("rank_ic").alias("days"))
    return out.withColumn("icir", F.when(F.col("ic_std") > 1e-12, F.col("ic_mean") / F.col("ic_std")))


def regime(x: Column, threshold: float) -> Column:
    """I4: bull, bear or neutral."""
    return F.when(x > threshold, "bull").when(x < -threshold, "bear").when(x.isNotNull(), "neutral")


def ic_statistics(ic: DataFrame, coverage: DataFrame) -> DataFrame:
    """Of daily correlations (feature, ic, rank_ic) and (feature, coverage): means,
    deviations and their ratios of both kinds, days, coverage and what is missing."""
    ratio = lambda m, s: F.when(F.col(s) > 1e-12, F.col(m) / F.col(s))
    out = ic.groupBy("feature").agg(
        F.count(F.lit(1)).alias("days"), F.avg("ic").alias("pearson_mean"), F.stddev_samp("ic").alias("pearson_std"), F.avg("rank_ic").alias("rank_mean"), F.stddev_samp("rank_ic").alias("rank_std"),
        F.avg((F.col("rank_ic") > 0).cast("double")).alias("positive_ratio"),
    )
    out = out.withColumns({"pearson_icir": ratio("pearson_mean", "pearson_std"), "rank_icir": ratio("rank_mean", "rank_std")})
    return out.join(coverage, "feature").withColumn("missing_ratio", 1 - F.col("coverage"))


def eligible_features(stats: DataFrame, least_coverage: float, least_days: int, score: str = "robust_score") -> DataFrame:
    """The features with enough coverage and days and a mean, best first: `place`
    is their order by score, ties by name."""
    ok = stats.where((F.col("coverage") >= least_coverage) & (F.col("days") >= least_days) & F.col("rank_mean").isNotNull())
    return ok.withColumn("place", F.row_number().over(Window.orderBy(F.desc(score), "feature")))


def evaluate_periods(daily: DataFrame, bridge: DataFrame, values: Sequence[str]) -> DataFrame:
    """For each period the mean of each daily value, its ratio to the
    deviation and the share of days on which it is positive."""
    aggs = [F.count(F.lit(1)).alias("days")]
    for v in values:
        sd = F.stddev_samp(v)
        aggs += [F.avg(v).alias(f"{v}_mean"), F.when(sd > 1e-12, F.avg(v) / sd).alias(f"{v}_ratio"), F.avg(F.when(F.col(v).isNotNull(), (F.col(v) > 0).cast("double"))).alias(f"{v}_positive")]
    return daily.join(bridge, "session").groupBy("period_type", "period").agg(*aggs)


def stability_score(summary: DataFrame, yearly: DataFrame, coverage: DataFrame) -> DataFrame:
    """The share of years whose mean has the overall sign, and
    abs(IC) * stability * sqrt(coverage), best first for features with any days. Means
    are rounded to nine places before their sign is taken, and a mean of zero agrees
    with no sign, so that rounding errors decide nothing."""
    sign = lambda x: F.signum(F.round(x, 9))
    both = yearly.select("feature", F.col("ic_mean").alias("_y")).join(summary, "feature")
    same = (sign("_y") == sign("ic_mean")) & (sign("_y") != 0)
    agree = both.groupBy("feature").agg(F.avg(same.cast("double")).alias("stability"))
    out = summary.join(agree, "feature").join(coverage, "feature")
    return out.where("days > 0").withColumn("robust_score", F.abs("ic_mean") * F.col("stability") * F.sqrt("coverage"))


def pair_correlations(df: DataFrame, features: Sequence[str], least: int = 3) -> DataFrame:
    """Correlations of all pairs over rows that have both. Every task sums the
    moments of all pairs in matrix products and returns a row for each pair, so what is
    shuffled depends on the number of features alone. Values are taken from the mean of
    their feature, so that large ones don't cancel out."""
    names = list(features)
    means = df.agg(*[F.avg(F.col(f).cast("double")).alias(f) for f in names])
    own = [F.coalesce(F.col(f).cast("double") - F.col(f"_m_{f}"), F.lit(float("nan"))).alias(f) for f in names]
    centred = df.select(*names).crossJoin(F.broadcast(means.select(*[F.col(f).alias(f"_m_{f}") for f in names]))).select(*own)

    def moments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((6, len(names), len(names)))
        for f in frames:
            x = f.to_numpy(float)
            there = np.isfinite(x)
            x, m = np.where(there, x, 0.0), there.astype(float)
            total += [m.T @ m, x.T @ m, m.T @ x, x.T @ x, (x * x).T @ m, m.T @ (x * x)]
        i, j = np.triu_indices(len(names), 1)
        yield pd.DataFrame({"i": i, "j": j} | {f"s{k}": total[k][i, j] for k in range(6)})

    sums = centred.mapInPandas(moments, "i int, j int, " + ", ".join(f"s{k} double" for k in range(6))).groupBy("i", "j").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(6)])
    n, mean = F.col("s0"), lambda k: F.col(f"s{k}") / F.col("s0")
    sd = F.sqrt(F.greatest(mean(4) - mean(1) * mean(1), F.lit(0.0))) * F.sqrt(F.greatest(mean(5) - mean(2) * mean(2), F.lit(0.0)))
    name = lambda c: F.get(F.array(*[F.lit(f) for f in names]), F.col(c))
    out = sums.where(n >= max(least, 1)).select(name("i").alias("left"), name("j").alias("right"), n.cast("long").alias("n"), F.when(sd > 1e-14, (mean(3) - mean(1) * mean(2)) / sd).alias("corr"))
    return out


def prune_correlated(pairs: DataFrame, scores: DataFrame, limit: float) -> DataFrame:
    """Goes through features, best score first (ties by name), and keeps those that
    no kept one is correlated with by limit or more, either way: feature, place, kept,
    and for the others kept_feature, the best kept one in their way, and correlation.

    Of pairs (left, right, corr) and scores (feature, score), both aggregates with a row for a
    pair or a feature. Each feature looks back only, at the earlier ones it is strongly
    correlated with, so the pass is one fold over an array of features."""
    placed = scores.select("feature", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("score"), "feature")).alias("place"))
    both = pairs.select("left", "right", "corr").unionByName(pairs.select(F.col("right").alias("left"), F.col("left").alias("right"), "corr"))
    strong = both.where(F.abs("corr") >= limit)
    earlier = placed.select(F.col("feature").alias("right"), F.col("place").alias("at"))
    back = strong.join(earlier, "right").join(placed.withColumnRenamed("feature", "left"), "left").where(F.col("at") < F.col("place"))
    back = back.groupBy("place").agg(F.sort_array(F.collect_list(F.struct("at", "corr"))).alias("near"))
    none = F.array().cast("array<struct<at:int,corr:double>>")
    rows = placed.join(back, "place", "left").select("place", F.coalesce("near", none).alias("near"))
    line = rows.agg(F.sort_array(F.collect_list(F.struct("place", "near"))).alias("line"))

    def step(done: Column, x: Column) -> Column:
        hit = F.get(F.filter(x["near"], lambda n: F.array_contains(done["kept"], n["at"])), F.lit(0))
        free = hit.isNull()
        told = F.struct(x["place"].alias("place"), free.alias("kept"), hit["at"].alias("at"), hit["corr"].alias("correlation"))
        return F.struct(F.when(free, F.concat(done["kept"], F.array(x["place"]))).otherwise(done["kept"]).alias("kept"), F.concat(done["told"], F.array(told)).alias("told"))

    start = F.struct(F.array().cast("array<int>").alias("kept"), F.array().cast("array<struct<place:int,kept:boolean,at:int,correlation:double>>").alias("told"))
    told = line.select(F.explode(F.aggregate("line", start, step)["told"]).alias("t")).select("t.*")
    winner = placed.select(F.col("place").alias("at"), F.col("feature").alias("kept_feature"))
    return told.join(placed, "place").join(winner, "at", "left").select("feature", "place", "kept", "kept_feature", "correlation")


def hash_sample(df: DataFrame, keys: Sequence[str], n: int, by: Sequence[str] = ()) -> DataFrame:
    """The first n rows by a hash of their keys, of each group of `by`; the
    hash is MD5, which any engine has."""
    h = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    if not by:
        return df.withColumn("_h", h).orderBy("_h", *keys).limit(n).drop("_h")
    spec = Window.partitionBy(*by).orderBy("_h", *keys)
    return df.withColumn("_h", h).withColumn("_n", F.row_number().over(spec)).where(F.col("_n") <= n).drop("_h", "_n")


def quantile_returns(rows: DataFrame, n: int, by: Sequence[str] = ("session", "feature")) -> DataFrame:
    """Mean target of each quantile of x per group, then over groups."""
    q = bucketize(avg_rank_pct("x", by), n, "floor_open")
    own = rows.where(F.col("x").isNotNull() & F.col("y").isNotNull()).withColumn("bucket", q)
    rest = [c for c in by if c != "session"]
    return own.groupBy(*by, "bucket").agg(F.avg("y").alias("_m")).groupBy(*rest, "bucket").agg(F.avg("_m").alias("mean_ret"), F.count(F.lit(1)).alias("days"))


def top_minus_bottom(buckets: DataFrame, n: int, by: Sequence[str] = ("feature",)) -> DataFrame:
    """The last quantile's mean return less the first's."""
    return buckets.groupBy(*by).agg((F.max(F.when(F.col("bucket") == n - 1, F.col("mean_ret"))) - F.max(F.when(F.col("bucket") == 0, F.col("mean_ret")))).alias("spread"))


def score_layers(scored: DataFrame, fractions: Sequence[float], bottom: float) -> DataFrame:
    """Overlapping layers by rank: the best of each fraction, and the bottom one.
    The cohort is counted before labels are looked at, so a missing label doesn't
    lift a lower rank into a layer."""
    r = ranked(scored, "score")
    n = F.col("cross_section_size")
    layers = [F.when(F.col("rank") <= F.ceil(n * f), F.lit(f"top_{round(f * 100)}")) for f in fractions]
    layers.append(F.when(F.col("rank") > F.floor(n * (1 - bottom)), F.lit("bottom")))
    return r.withColumn("layer", F.explode(F.array_compact(F.array(*layers))))


def layer_returns(layers: DataFrame, y: str = "y") -> DataFrame:
    """Mean return of a session's layer, and the share of it with a label."""
    return layers.groupBy("session", "layer").agg(F.avg(y).alias("ret"), F.count(y).alias("labelled"), F.count(F.lit(1)).alias("n")).withColumn("coverage", F.col("labelled") / F.col("n"))


def path_metrics(rows: DataFrame, by: Sequence[str], order: str, ret: str, periods: float) -> DataFrame:
    """Total and annual return, volatility, Sharpe ratio, worst drawdown and win
    rate of each path of returns. Peaks are those of the path itself: what it starts
    from is none."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    curve = rows.where(F.col(ret).isNotNull()).withColumn("_log", F.sum(F.log1p(F.greatest(F.col(ret), F.lit(-0.999999)))).over(w))
    curve = curve.withColumn("_dd", F.exp(F.col("_log") - F.max("_log").over(w)) - 1)
    out = curve.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        (F.exp(F.max_by("_log", order)) - 1).alias("total_return"),
        (F.exp(F.max_by("_log", order) * periods / F.count(F.lit(1))) - 1).alias("annual_return"),
        (F.stddev_samp(ret) * math.sqrt(periods)).alias("volatility"),
        F.when(F.stddev_samp(ret) > 1e-12, F.avg(ret) / F.stddev_samp(ret) * math.sqrt(periods)).alias("sharpe"),
        F.min("_dd").alias("max_drawdown"),
        F.avg((F.col(ret) > 0).cast("double")).alias("win_rate"),
    )
    return out


def relative_metrics(rows: DataFrame, by: Sequence[str], ret: str, bench: str, periods: float, risk_free: float = 0.0) -> DataFrame:
    """Returns against a benchmark's on the rows that have both: what each
    compounds to, the compounded excess, the information ratio, and the Sharpe ratio
    over a yearly risk-free rate."""
    both = rows.where(F.col(ret).isNotNull() & F.col(bench).isNotNull())
    grown = lambda c: F.exp(F.sum(F.log1p(F.greatest(F.col(c), F.lit(-0.999999))))) - 1
    free, active = (1 + risk_free) ** (1 / periods) - 1, F.col(ret) - F.col(bench)
    over = lambda mean, sd: F.when(sd > 1e-12, mean / sd * math.sqrt(periods))
    out = both.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), grown(ret).alias("total_return"), grown(bench).alias("benchmark_return"),
        over(F.avg(active), F.stddev_samp(active)).alias("information_ratio"), over(F.avg(F.col(ret) - free), F.stddev_samp(ret)).alias("sharpe"),
    )
    return out.withColumn("excess_return", (1 + F.col("total_return")) / (1 + F.col("benchmark_return")) - 1)


def layer_summary(daily: DataFrame, horizon: int, periods: float) -> DataFrame:
    """A layer's sessions fall into `horizon` vintages that don't overlap; the
    median of their total and annual returns, and the worst drawdown. Mean, Sharpe ratio,
    win rate and coverage are of all its sessions."""
    daily = daily.where("ret IS NOT NULL")
    sd = F.stddev_samp("ret")
    every = daily.groupBy("layer").agg(
        F.count(F.lit(1)).alias("observations"), F.avg("ret").alias("mean_ret"), F.when(sd > 1e-12, F.avg("ret") / sd * math.sqrt(periods / horizon)).alias("sharpe"),
        F.avg((F.col("ret") > 0).cast("double")).alias("win_rate"), F.avg("coverage").alias("coverage"),
    )
    n = F.row_number().over(Window.partitionBy("layer").orderBy("session"))
    paths = path_metrics(daily.withColumn("vintage", F.pmod(n - 1, F.lit(horizon))), ["layer", "vintage"], "session", "ret", periods / horizon)
    return paths.groupBy("layer").agg(F.percentile("total_return", F.lit(0.5)).alias("total_return"), F.percentile("annual_return", F.lit(0.5)).alias("annual_return"), F.min("max_drawdown").alias("max_drawdown"), F.count(F.lit(1)).alias("vintages")).join(every, "layer")


def monthly_stability(daily: DataFrame, ic: DataFrame) -> DataFrame:
    """By month, a layer's mean return and win rate beside the mean rank IC."""
    month = F.to_date(F.date_trunc("month", "session"))
    a = daily.groupBy(month.alias("month"), "layer").agg(F.avg("ret").alias("ret"), F.avg((F.col("ret") > 0).cast("double")).alias("win_rate"))
    return a.join(ic.groupBy(month.alias("month")).agg(F.avg("rank_ic").alias("rank_ic")), "month", "left")


def ndcg(scored: DataFrame, relevance: str, k: int, by: Sequence[str] = ("session",)) -> DataFrame:
    """Normalized discounted gain of the best k by score, gains 2^rel - 1."""
    rows = scored.where(F.col(relevance).isNotNull() & F.col("score").isNotNull())
    rows = rows.withColumn("_p", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), "entity"))).withColumn("_i", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(relevance), "entity")))
    gain = lambda p: F.sum(F.when(F.col(p) <= k, (F.pow(F.lit(2.0), F.col(relevance)) - 1) / F.log2(F.col(p) + F.lit(1.0))).otherwise(0.0))
    return rows.groupBy(*by).agg(gain("_p").alias("_dcg"), gain("_i").alias("_best")).select(*by, F.when(F.col("_best") > 0, F.col("_dcg") / F.col("_best")).otherwise(0.0).alias("ndcg"))


def period_bridge(sessions: DataFrame, regimes: DataFrame | None = None) -> DataFrame:
    """(session, period_type, period): overall, year, month, and regime."""
    s = F.col("session")
    kinds = [("overall", F.lit("all")), ("year", F.date_format(s, "yyyy")), ("month", F.date_format(s, "yyyyMM"))]
    rows = sessions.select("session").distinct()
    if regimes is not None:
        rows = rows.join(regimes.select("session", "regime"), "session", "left")
        kinds.append(("regime", F.col("regime")))
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("period_type"), v.alias("period")) for k, v in kinds]))
    return rows.select("session", each.alias("p")).select("session", "p.*").where("period IS NOT NULL")


def period_metrics(daily: DataFrame, bridge: DataFrame, by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Means of daily values for each period, by one grouping."""
    return daily.join(bridge, "session").groupBy(*by, "period_type", "period").agg(*[F.avg(v).alias(v) for v in values], F.count(F.lit(1)).alias("days"))


def criteria(row: DataFrame, rules: Mapping[str, tuple[Column, float]]) -> DataFrame:
    """One row per criterion: its value, threshold, and whether it is reached."""
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("criterion"), v.cast("double").alias("value"), F.lit(float(t)).alias("threshold"), F.coalesce(v >= t, F.lit(False)).alias("passed")) for n, (v, t) in rules.items()]))
    return row.select(each.alias("c")).select("c.*")


def set_turnover(top: DataFrame, cal: DataFrame) -> DataFrame:
    """1 - kept / max(size, previous size, 1) of a session's set against the
    previous session's."""
    placed = top.join(F.broadcast(cal), "session").select("pos", "entity")
    size = placed.groupBy("pos").agg(F.count(F.lit(1)).alias("n"))
    kept = placed.join(placed.select((F.col("pos") + 1).alias("pos"), "entity"), ["pos", "entity"]).groupBy("pos").agg(F.count(F.lit(1)).alias("k"))
    before = size.select((F.col("pos") + 1).alias("pos"), F.col("n").alias("m"))
    both = size.join(before, "pos").join(kept, "pos", "left")
    out = both.select("pos", (1 - F.coalesce("k", F.lit(0)) / F.greatest("n", "m", F.lit(1))).alias("turnover"))
    return out.join(F.broadcast(cal), "pos").select("session", "turnover")


def scorecard(metrics: DataFrame, higher: Sequence[str], lower: Sequence[str] = ()) -> DataFrame:
    """The mean of a set's ranks over its metrics; the lowest is best."""
    ranks = [F.rank().over(Window.orderBy(F.col(c).desc_nulls_last())) for c in higher] + [F.rank().over(Window.orderBy(F.col(c).asc_nulls_last())) for c in lower]
    total = ranks[0]
    for r in ranks[1:]:
        total = total + r
    return metrics.withColumn("mean_rank", total / len(ranks))


def distributions(rows: DataFrame, label: str, values: Sequence[str]) -> DataFrame:
    """The spread of each metric over folds, with the best and worst fold."""
    long = long_form(rows, [label], values)
    return long.where("x IS NOT NULL").groupBy(F.col("feature").alias("metric")).agg(
        F.avg("x").alias("mean"), F.percentile("x", F.lit(0.5)).alias("median"), F.stddev_samp("x").alias("std"), F.min("x").alias("min"), F.max("x").alias("max"),
        F.avg((F.col("x") > 0).cast("double")).alias("positive_ratio"), F.max_by(label, F.struct("x", label)).alias("best"), F.min_by(label, F.struct("x", label)).alias("worst"),
    )


def importance_stability(rows: DataFrame) -> DataFrame:
    """Of (fold, feature, importance): each feature's ranks over the folds."""
    r = rows.withColumn("r", F.row_number().over(Window.partitionBy("fold").orderBy(F.desc("importance"), "feature")))
    return r.groupBy("feature").agg(F.percentile("r", F.lit(0.5)).alias("median_rank"), F.stddev_samp("r").alias("rank_std"), F.count(F.lit(1)).alias("folds"))


def score_consistency(a: DataFrame, b: DataFrame) -> DataFrame:
    """How far two runs' scores of the same rows agree."""
    both = a.select("session", "entity", F.col("score").alias("x")).join(b.select("session", "entity", F.col("score").alias("y")), ["session", "entity"])
    return daily_ic(both, ["session"]).agg(F.avg("ic").alias("pearson"), F.avg("rank_ic").alias("spearman"), F.sum("n").alias("n"))


def metric_deltas(a: DataFrame, b: DataFrame, limits: Mapping[str, float]) -> DataFrame:
    """Of two runs' metrics (metric, value): metric, a, b, delta (absolute) and passed,
    whether it is within the metric's limit; a metric that one run lacks has not passed, and
    one without a limit has null there."""
    both = a.select("metric", F.col("value").alias("a")).join(b.select("metric", F.col("value").alias("b")), "metric", "full")
    limit = F.create_map(*[x for k, v in limits.items() for x in (F.lit(k), F.lit(float(v)))]) if limits else F.create_map().cast("map<string,double>")
    delta = F.abs(F.col("a") - F.col("b"))
    within = F.when(F.try_element_at(limit, "metric").isNotNull(), F.coalesce(delta <= F.try_element_at(limit, "metric"), F.lit(False)))
    return both.select("metric", "a", "b", delta.alias("delta"), within.alias("passed"))


def yearly_metrics(daily: DataFrame, periods: float, bull: float, bear: float, risk_free: float = 0.0) -> DataFrame:
    """Of a portfolio's sessions (session, ret, bench_ret, turnover) for each year: regime (bull if the
    benchmark's compounded return is `bull` or more, bear if `bear` or less, else neutral),
    compounded, benchmark and excess return, volatility, Sharpe ratio over the risk-free rate, the worst
    drawdown, share of winning sessions and mean turnover."""
    rows = daily.where("ret IS NOT NULL").withColumn("year", F.year("session"))
    free = (1 + risk_free) ** (1 / periods) - 1
    grown = lambda c: F.exp(F.sum(F.log1p(F.greatest(F.col(c), F.lit(-0.999999))))) - 1
    sd = F.stddev_samp("ret")
    one = rows.groupBy("year").agg(grown("bench_ret").alias("benchmark_return"), (F.coalesce(sd, F.lit(0.0)) * math.sqrt(periods)).alias("volatility"), F.when(sd > 0, (F.avg("ret") - free) / sd * math.sqrt(periods)).alias("sharpe"), F.avg("turnover").alias("turnover"))
    path = path_metrics(rows, ["year"], "session", "ret", periods).select("year", F.col("total_return").alias("cumulative_return"), "max_drawdown", "win_rate")
    bench = F.coalesce("benchmark_return", F.lit(0.0))
    kind = F.when(bench >= bull, "bull").when(bench <= bear, "bear").otherwise("neutral")
    return path.join(one, "year").withColumns({"regime": kind, "excess_return": (1 + F.col("cumulative_return")) / (1 + bench) - 1})


def comparison_frame(challenger: DataFrame, champion: DataFrame, labels: DataFrame) -> DataFrame:
    """Both models' scores of the rows they share, with the label where there is
    one. The three are keyed alike, so one shuffle of each serves both joins."""
    key = ["session", "entity"]
    both = challenger.select(*key, F.col("score").alias("challenger")).join(champion.select(*key, F.col("score").alias("champion")), key)
    return both.join(labels.select(*key, "y"), key, "left")


def contributions(rows: DataFrame, keys: Sequence[str], features: Sequence[str], score: str, tolerance: float) -> tuple[DataFrame, DataFrame]:
    """Rows whose contributions don't add up to the score, and the mean absolute
    contribution of each feature."""
    total = F.col(features[0])
    for f in features[1:]:
        total = total + F.col(f)
    off = rows.where(F.abs(total - F.col(score)) > tolerance).select(*keys)
    means = long_form(rows, keys, features).groupBy("feature").agg(F.avg(F.abs("x")).alias("importance"))
    return off, means

