"""Queries over diagnostics, drift, quality and monitoring (I, J, K, L, A)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import diagnostics as D
from ..operators import drift as K
from ..operators import labels as L
from ..operators import monitor as M
from ..operators import quality as Q
from ..operators import ranks as G
from ..operators import rolling as R
from ..sources import store as S
from .base import PANEL, bars, calendar, panel, pct, query, read, root_of
from .features import scored
from .labelling import _LABELS, _LIMITS, base_panel, labels

KEY = ["entity", "session"]
FEATURES = ("f_ret", "f_vol", "f_amount")

#: Features with the label of the next session.
_FRAME = f"{_LABELS}, feat AS (SELECT entity, session, pos, grp, bench_ret, -ret_1d AS f_ret, vol AS f_vol, round(amount / vol, 9) AS f_amount FROM rets WHERE traded), frame AS (SELECT f.*, l.future_excess_ret AS y, l.benchmark_forward_ret AS by_ FROM feat f LEFT JOIN (SELECT * FROM labels WHERE horizon = 1) l ON l.entity = f.entity AND l.session = f.session), long AS (" + " UNION ALL ".join(f"SELECT entity, session, pos, '{f}' AS feature, round({f}, 9) AS x, y FROM frame" for f in FEATURES) + ")"
_BOTH = "pairs AS (SELECT *, round(y, 12) AS yy FROM long WHERE x IS NOT NULL AND y IS NOT NULL), rk AS (SELECT *, rank() OVER (PARTITION BY session, feature ORDER BY x) + (count(*) OVER (PARTITION BY session, feature, x) - 1) / 2.0 AS rx, rank() OVER (PARTITION BY session, feature ORDER BY y) + (count(*) OVER (PARTITION BY session, feature, y) - 1) / 2.0 AS ry FROM pairs)"
_IC = f"{_FRAME}, {_BOTH}, ic AS (SELECT session, feature, CASE WHEN stddev_pop(x) * stddev_pop(y) > 1e-14 THEN (avg(x * y) - avg(x) * avg(y)) / (stddev_pop(x) * stddev_pop(y)) END AS ic, CASE WHEN stddev_pop(rx) * stddev_pop(ry) > 1e-14 THEN (avg(rx * ry) - avg(rx) * avg(ry)) / (stddev_pop(rx) * stddev_pop(ry)) END AS rank_ic, count(*) AS n FROM rk GROUP BY 1, 2 HAVING count(*) >= 5)"
_SUMMARY = "avg(rank_ic) AS ic_mean, stddev_samp(rank_ic) AS ic_std, avg(CAST(rank_ic > 0 AS INTEGER)) AS positive_ratio, count(rank_ic) AS days, avg(rank_ic) / CASE WHEN stddev_samp(rank_ic) > 1e-12 THEN stddev_samp(rank_ic) END AS icir"
_ROUNDED = "round(ic_mean, 4) AS ic_mean, round(ic_std, 4) AS ic_std, round(positive_ratio, 4) AS positive_ratio, days, round(icir, 4) AS icir"


def frame(spark, sf):
    f = R.with_returns(panel(spark, sf)).where("traded")
    f = f.select(*KEY, "pos", "grp", "bench_ret", (-F.col("ret_1d")).alias("f_ret"), F.col("vol").alias("f_vol"), F.round(F.col("amount") / F.col("vol"), 9).alias("f_amount"))
    y = labels(spark, sf).where("horizon = 1").select(*KEY, F.col("future_excess_ret").alias("y"), F.col("benchmark_forward_ret").alias("by_"))
    return f.join(y, KEY, "left")


def long(spark, sf):
    return D.long_form(frame(spark, sf), [*KEY, "pos", "y"], FEATURES).withColumn("x", F.round("x", 9))


def ics(spark, sf):
    return D.daily_ic(long(spark, sf))


@query("i01_daily_ic", f"{PANEL}, {_IC} SELECT session, feature, round(ic, 4) AS ic, round(rank_ic, 4) AS rank_ic, n FROM ic", digits=4)
def daily_ic(spark, sf):
    return ics(spark, sf)


@query("i02_summary_ic", f"{PANEL}, {_IC}, s AS (SELECT feature, {_SUMMARY} FROM ic GROUP BY 1) SELECT feature, {_ROUNDED} FROM s", digits=4)
def summary(spark, sf):
    return D.summarize_ic(ics(spark, sf))


@query("i03_yearly_ic", f"{PANEL}, {_IC}, s AS (SELECT feature, year(session) AS year, {_SUMMARY} FROM ic GROUP BY 1, 2) SELECT feature, CAST(year AS INTEGER) AS year, {_ROUNDED} FROM s", digits=4)
def yearly(spark, sf):
    return D.summarize_ic(ics(spark, sf).withColumn("year", F.year("session")), ["feature", "year"])


@query("i04_regime_ic", f"{PANEL}, {_IC}, g AS (SELECT session, max(by_) AS b FROM frame GROUP BY 1), s AS (SELECT feature, CASE WHEN b > 0.01 THEN 'bull' WHEN b < -0.01 THEN 'bear' WHEN b IS NOT NULL THEN 'neutral' END AS regime, {_SUMMARY} FROM ic JOIN g USING (session) GROUP BY 1, 2) SELECT feature, regime, {_ROUNDED} FROM s", digits=4)
def regimes(spark, sf):
    g = frame(spark, sf).groupBy("session").agg(D.regime(F.max("by_"), 0.01).alias("regime"))
    return D.summarize_ic(ics(spark, sf).join(g, "session"), ["feature", "regime"])


@query("i05_i06_stability", f"{PANEL}, {_IC}, s AS (SELECT feature, {_SUMMARY} FROM ic GROUP BY 1), y AS (SELECT feature, year(session) AS year, avg(rank_ic) AS m FROM ic GROUP BY 1, 2), a AS (SELECT feature, avg(CAST(sign(round(m, 9)) = sign(round(ic_mean, 9)) AND round(m, 9) <> 0 AS INTEGER)) AS stability FROM y JOIN s USING (feature) GROUP BY 1), c AS (SELECT feature, avg(CAST(x IS NOT NULL AS INTEGER)) AS coverage FROM long GROUP BY 1) SELECT feature, round(stability, 4) AS stability, round(coverage, 4) AS coverage, round(abs(ic_mean) * stability * sqrt(coverage), 4) AS robust_score FROM s JOIN a USING (feature) JOIN c USING (feature) WHERE days > 0", digits=4)
def stability(spark, sf):
    rows = long(spark, sf)
    ic = D.daily_ic(rows)
    cover = rows.groupBy("feature").agg(F.avg(F.col("x").isNotNull().cast("double")).alias("coverage"))
    out = D.stability_score(D.summarize_ic(ic), D.summarize_ic(ic.withColumn("year", F.year("session")), ["feature", "year"]), cover)
    return out.select("feature", "stability", "coverage", "robust_score")


@query("i07_pair_correlations", f"{PANEL}, {_FRAME} " + " UNION ALL ".join(f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", count(*) AS n, round((avg({a} * {b}) - avg({a}) * avg({b})) / (stddev_pop({a}) * stddev_pop({b})), 4) AS corr FROM frame WHERE {a} IS NOT NULL AND {b} IS NOT NULL" for a, b in (("f_ret", "f_vol"), ("f_ret", "f_amount"), ("f_vol", "f_amount"))), digits=4)
def pair_correlations(spark, sf):
    return D.pair_correlations(frame(spark, sf), FEATURES)


#: Columns of the panel as features, among which some say the same.
_WIDE = {"f_open": "open", "f_high": "high", "f_low": "low", "f_close": "close", "f_vol": "vol", "f_amount": "amount", "f_ret": "ret_1d", "f_bench": "bench_ret", "f_body": "close / open - 1", "f_span": "high - low"}
_PAIRS = [(a, b) for i, a in enumerate(_WIDE) for b in list(_WIDE)[i + 1 :]]


@query(
    "i07_pruned_features",
    PANEL.replace("WITH ", "WITH RECURSIVE ", 1)
    + ", wide AS MATERIALIZED (SELECT "
    + ", ".join(f"{x} AS {f}" for f, x in _WIDE.items())
    + " FROM rets WHERE traded), cors AS MATERIALIZED ("
    + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS c FROM wide" for a, b in _PAIRS)
    + "), cover AS ("
    + " UNION ALL ".join(f"SELECT '{f}' AS feature, count({f}) AS score FROM wide" for f in _WIDE)
    + "), ord AS MATERIALIZED (SELECT feature, CAST(row_number() OVER (ORDER BY score DESC, feature) AS INTEGER) AS place FROM cover), "
    "strong AS (SELECT a, b, c FROM cors WHERE abs(c) >= 0.6 UNION ALL SELECT b, a, c FROM cors WHERE abs(c) >= 0.6), "
    "near AS MATERIALIZED (SELECT o.place, o.feature, coalesce((SELECT list(e.place) FROM strong s JOIN ord e ON e.feature = s.a WHERE s.b = o.feature AND e.place < o.place), []) AS near FROM ord o), "
    "walk AS (SELECT 0 AS place, CAST([] AS INTEGER[]) AS kept UNION ALL SELECT n.place, CASE WHEN list_has_any(w.kept, n.near) THEN w.kept ELSE list_append(w.kept, n.place) END FROM walk w JOIN near n ON n.place = w.place + 1), "
    "told AS (SELECT n.feature, n.place, list_contains(w.kept, n.place) AS kept, list_min(list_intersect(w.kept, n.near)) AS at FROM near n JOIN walk w ON w.place = n.place) "
    "SELECT t.feature, t.place, t.kept, CASE WHEN NOT t.kept THEN o.feature END AS kept_feature, CASE WHEN NOT t.kept THEN round(s.c, 4) END AS correlation FROM told t LEFT JOIN ord o ON o.place = t.at LEFT JOIN strong s ON s.a = o.feature AND s.b = t.feature",
    digits=4,
)
def pruned(spark, sf):
    rows = R.with_returns(panel(spark, sf)).where("traded").select(*[F.expr(x).alias(f) for f, x in _WIDE.items()])
    cover = rows.agg(*[F.count(f).alias(f) for f in _WIDE]).select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("score")) for f in _WIDE])).alias("x")).select("x.*")
    return D.prune_correlated(D.pair_correlations(rows, list(_WIDE)), cover, 0.6)


@query("i09_j12_hash_sample", "SELECT month, o_orderkey FROM (SELECT strftime(o_orderdate, '%Y%m') AS month, o_orderkey, row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y%m') ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) AS n FROM orders) WHERE n <= 20")
def sample(spark, sf):
    o = read(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyyMM").alias("month"), "o_orderkey")
    return D.hash_sample(o, ["o_orderkey"], 20, ["month"])


_BUCKETS = f"{_FRAME}, b0 AS (SELECT *, {pct('x', 'session, feature')} AS p FROM long), b1 AS (SELECT session, feature, CAST(least(4, floor((p - 2.220446049250313e-16) * 5)) AS INTEGER) AS bucket, avg(y) AS m FROM (SELECT *, {pct('x', 'session, feature')} AS p FROM long WHERE x IS NOT NULL AND y IS NOT NULL) GROUP BY 1, 2, 3), bk AS (SELECT feature, bucket, avg(m) AS mean_ret, count(*) AS days FROM b1 GROUP BY 1, 2)"


@query("i10_quantile_returns", f"{PANEL}, {_BUCKETS} SELECT feature, bucket, round(mean_ret, 4) AS mean_ret, days, round(max(CASE WHEN bucket = 4 THEN mean_ret END) OVER (PARTITION BY feature) - max(CASE WHEN bucket = 0 THEN mean_ret END) OVER (PARTITION BY feature), 4) AS spread FROM bk", digits=4)
def quantile_returns(spark, sf):
    b = D.quantile_returns(long(spark, sf), 5)
    return b.join(D.top_minus_bottom(b, 5), "feature").select("feature", "bucket", "mean_ret", "days", "spread")


_LAYERS = f"{_FRAME}, sc AS (SELECT entity, session, round(f_ret, 9) AS score, y FROM frame), rkd AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY score DESC NULLS LAST, entity) AS rank, count(*) OVER (PARTITION BY session) AS n FROM sc), lay AS (SELECT *, 'top_10' AS layer FROM rkd WHERE rank <= ceil(n * 0.1) UNION ALL SELECT *, 'top_30' FROM rkd WHERE rank <= ceil(n * 0.3) UNION ALL SELECT *, 'bottom' FROM rkd WHERE rank > floor(n * (1 - 0.2))), dl AS (SELECT session, layer, avg(y) AS ret, count(y) AS labelled, count(*) AS n FROM lay GROUP BY 1, 2)"


def scores(spark, sf):
    return frame(spark, sf).select(*KEY, F.round("f_ret", 9).alias("score"), "y")


def layers(spark, sf):
    return D.layer_returns(D.score_layers(scores(spark, sf), (0.1, 0.3), 0.2))


@query("i11_i12_layer_returns", f"{PANEL}, {_LAYERS} SELECT session, layer, round(ret, 6) AS ret, labelled, n, round(labelled / n, 6) AS coverage FROM dl")
def layer_returns(spark, sf):
    return layers(spark, sf)


def _paths(source: str, by: str, order: str, ret: str, periods: str) -> str:
    return f"pc AS (SELECT *, sum(ln(1 + greatest({ret}, -0.999999))) OVER w AS lg FROM {source} WHERE {ret} IS NOT NULL WINDOW w AS (PARTITION BY {by} ORDER BY {order} ROWS UNBOUNDED PRECEDING)), pd AS (SELECT *, exp(lg - max(lg) OVER (PARTITION BY {by} ORDER BY {order} ROWS UNBOUNDED PRECEDING)) - 1 AS dd FROM pc), pm AS (SELECT {by}, count(*) AS n, exp(arg_max(lg, {order})) - 1 AS total_return, exp(arg_max(lg, {order}) * {periods} / count(*)) - 1 AS annual_return, stddev_samp({ret}) * sqrt({periods}) AS volatility, CASE WHEN stddev_samp({ret}) > 1e-12 THEN avg({ret}) / stddev_samp({ret}) * sqrt({periods}) END AS sharpe, min(dd) AS max_drawdown, avg(CAST({ret} > 0 AS INTEGER)) AS win_rate FROM pd GROUP BY {by})"


@query("i13_layer_summary", f"{PANEL}, {_LAYERS}, vin AS (SELECT *, (row_number() OVER (PARTITION BY layer ORDER BY session) - 1) % 5 AS vintage FROM (SELECT session, layer, ret * 0.02 AS ret, labelled / n AS coverage FROM dl) WHERE ret IS NOT NULL), {_paths('vin', 'layer, vintage', 'session', 'ret', '10.4')}, al AS (SELECT layer, count(*) AS observations, avg(ret) AS mean_ret, CASE WHEN stddev_samp(ret) > 1e-12 THEN avg(ret) / stddev_samp(ret) * sqrt(10.4) END AS sharpe, avg(CAST(ret > 0 AS INTEGER)) AS win_rate, avg(coverage) AS coverage FROM vin GROUP BY 1) SELECT p.*, observations, round(mean_ret, 4) AS mean_ret, round(sharpe, 4) AS sharpe, round(win_rate, 4) AS win_rate, round(coverage, 4) AS coverage FROM (SELECT layer, round(quantile_cont(total_return, 0.5), 4) AS total_return, round(quantile_cont(annual_return, 0.5), 3) AS annual_return, round(min(max_drawdown), 4) AS max_drawdown, count(*) AS vintages FROM pm GROUP BY 1) p JOIN al USING (layer)", digits=4)
def layer_summary(spark, sf):
    # synthetic returns are large; a fiftieth keeps compounding in range
    out = D.layer_summary(layers(spark, sf).withColumn("ret", F.col("ret") * 0.02), 5, 52.0)
    return out.withColumn("annual_return", F.round(F.col("annual_return") + 1e-9, 3))


@query("i14_monthly_stability", f"{PANEL}, {_IC.replace(_FRAME, _LAYERS)}, mi AS (SELECT date_trunc('month', session) AS m, avg(rank_ic) AS rank_ic FROM ic WHERE feature = 'f_ret' GROUP BY 1), ml AS (SELECT date_trunc('month', session) AS m, layer, avg(ret) AS ret, avg(CAST(ret > 0 AS INTEGER)) AS win_rate FROM dl GROUP BY 1, 2) SELECT CAST(m AS DATE) AS month, layer, round(ret, 4) AS ret, round(win_rate, 4) AS win_rate, round(rank_ic, 4) AS rank_ic FROM ml LEFT JOIN mi USING (m)", digits=4)
def monthly(spark, sf):
    return D.monthly_stability(layers(spark, sf), ics(spark, sf).where("feature = 'f_ret'"))


_NDCG = f"{_FRAME}, nd0 AS (SELECT f.entity, f.session, round(f_ret, 9) AS score, label_quantile AS rel FROM frame f JOIN (SELECT * FROM labels WHERE horizon = 1) l ON l.entity = f.entity AND l.session = f.session WHERE label_quantile IS NOT NULL AND f_ret IS NOT NULL), nd1 AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY score DESC, entity) AS p, row_number() OVER (PARTITION BY session ORDER BY rel DESC, entity) AS i FROM nd0), nd AS (SELECT session, sum(CASE WHEN p <= 10 THEN (pow(2, rel) - 1) / log2(p + 1) ELSE 0 END) AS dcg, sum(CASE WHEN i <= 10 THEN (pow(2, rel) - 1) / log2(i + 1) ELSE 0 END) AS best FROM nd1 GROUP BY 1)"


@query("i15_ndcg", f"{PANEL}, {_NDCG} SELECT session, round(CASE WHEN best > 0 THEN dcg / best ELSE 0 END, 6) AS ndcg FROM nd")
def ndcg(spark, sf):
    lab = labels(spark, sf).where("horizon = 1").select(*KEY, "label_quantile")
    return D.ndcg(scores(spark, sf).join(lab, KEY), "label_quantile", 10)


@query("i16_i18_period_metrics", f"{PANEL}, {_IC}, t AS (SELECT session, feature, rank_ic FROM ic WHERE feature IN ('f_ret', 'f_vol')), p AS (SELECT DISTINCT session FROM t), br AS (SELECT session, 'overall' AS period_type, 'all' AS period FROM p UNION ALL SELECT session, 'year', strftime(session, '%Y') FROM p UNION ALL SELECT session, 'month', strftime(session, '%Y%m') FROM p) SELECT feature, period_type, period, round(avg(rank_ic), 4) AS rank_ic, count(*) AS days FROM t JOIN br USING (session) GROUP BY 1, 2, 3", digits=4)
def period_metrics(spark, sf):
    ic = ics(spark, sf).where("feature IN ('f_ret', 'f_vol')").select("session", "feature", "rank_ic")
    return D.period_metrics(ic, D.period_bridge(ic), ["feature"], ["rank_ic"])


@query("i19_i21_criteria", f"{PANEL}, {_IC}, s AS (SELECT feature, {_SUMMARY} FROM ic GROUP BY 1), r AS (SELECT feature, (rank() OVER (ORDER BY abs(round(ic_mean, 6)) DESC) + rank() OVER (ORDER BY round(ic_std, 6))) / 2 AS mean_rank, positive_ratio FROM s), c AS (SELECT max(positive_ratio) AS v, min(mean_rank) AS w FROM r) SELECT 'best_positive_ratio' AS criterion, round(v, 4) AS value, 0.5 AS threshold, v >= 0.5 AS passed FROM c UNION ALL SELECT 'mean_rank', round(w, 4), 1.0, w >= 1 FROM c", digits=4)
def criteria(spark, sf):
    s = D.summarize_ic(ics(spark, sf)).withColumns({"a": F.abs(F.round("ic_mean", 6)), "ic_std": F.round("ic_std", 6)})
    card = D.scorecard(s, ["a"], ["ic_std"]).agg(F.max("positive_ratio").alias("v"), F.min("mean_rank").alias("w"))
    return D.criteria(card, {"best_positive_ratio": (F.col("v"), 0.5), "mean_rank": (F.col("w"), 1.0)})


@query("i20_set_turnover", f"{PANEL}, {_LAYERS}, t AS (SELECT l.entity, c.pos, c.session FROM lay l JOIN cal c ON c.session = l.session WHERE layer = 'top_10'), n AS (SELECT pos, session, count(*) AS n FROM t GROUP BY 1, 2), k AS (SELECT a.pos, count(*) AS k FROM t a JOIN t b ON b.entity = a.entity AND b.pos = a.pos - 1 GROUP BY 1) SELECT x.session, round(1 - coalesce(k, 0) / greatest(x.n, y.n, 1), 6) AS turnover FROM n x JOIN n y ON y.pos = x.pos - 1 LEFT JOIN k ON k.pos = x.pos")
def turnover(spark, sf):
    top = D.score_layers(scores(spark, sf), (0.1, 0.3), 0.2).where("layer = 'top_10'")
    return D.set_turnover(top.select(*KEY), calendar(spark, sf))


@query("i22_i23_fold_spread", f"{PANEL}, {_IC}, y AS (SELECT feature, CAST(year(session) AS INTEGER) AS fold, round(avg(rank_ic), 9) AS m FROM ic GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY abs(m) DESC, feature) AS r FROM y) SELECT feature, round(avg(m), 4) AS mean, round(quantile_cont(m, 0.5), 4) AS median, round(stddev_samp(m), 4) AS std, round(min(m), 4) AS min, round(max(m), 4) AS max, round(avg(CAST(m > 0 AS INTEGER)), 4) AS positive_ratio, arg_max(fold, row(m, fold)) AS best, arg_min(fold, row(m, fold)) AS worst, round(quantile_cont(r, 0.5), 4) AS median_rank, round(stddev_samp(r), 4) AS rank_std FROM r GROUP BY 1", digits=4)
def fold_spread(spark, sf):
    y = ics(spark, sf).groupBy("feature", F.year("session").alias("fold")).agg(F.round(F.avg("rank_ic"), 9).alias("m"))
    wide = y.groupBy("fold").pivot("feature", list(FEATURES)).agg(F.first("m"))
    spread = D.distributions(wide, "fold", FEATURES).withColumnRenamed("metric", "feature")
    ranks = D.importance_stability(y.withColumn("importance", F.abs("m"))).drop("folds")
    return spread.join(ranks, "feature")


@query("i24_d15_score_consistency", f"{PANEL}, {_FRAME}, p AS (SELECT session, round(f_ret, 9) AS x, round(f_ret + f_vol / 100, 9) AS y FROM frame WHERE f_ret IS NOT NULL), r AS (SELECT *, rank() OVER (PARTITION BY session ORDER BY x) + (count(*) OVER (PARTITION BY session, x) - 1) / 2.0 AS rx, rank() OVER (PARTITION BY session ORDER BY y) + (count(*) OVER (PARTITION BY session, y) - 1) / 2.0 AS ry FROM p), d AS (SELECT session, (avg(x * y) - avg(x) * avg(y)) / (stddev_pop(x) * stddev_pop(y)) AS ic, (avg(rx * ry) - avg(rx) * avg(ry)) / (stddev_pop(rx) * stddev_pop(ry)) AS rank_ic, count(*) AS n FROM r GROUP BY 1 HAVING count(*) >= 5) SELECT round(avg(ic), 4) AS pearson, round(avg(rank_ic), 4) AS spearman, CAST(sum(n) AS BIGINT) AS n FROM d", digits=4)
def consistency(spark, sf):
    f = frame(spark, sf)
    a = f.select(*KEY, F.round("f_ret", 9).alias("score"))
    return D.score_consistency(a, f.select(*KEY, F.round(F.col("f_ret") + F.col("f_vol") / 100, 9).alias("score")))


@query("i25_contributions", "WITH c AS (SELECT l_extendedprice * (1 - l_discount) AS net, l_extendedprice * l_discount AS disc, l_extendedprice + CASE WHEN l_orderkey % 97 = 0 THEN 1 ELSE 0 END AS score FROM lineitem) SELECT 'net' AS feature, round(avg(abs(net)), 4) AS importance, count(*) FILTER (abs(net + disc - score) > 1e-3) AS n_off FROM c UNION ALL SELECT 'disc', round(avg(abs(disc)), 4), count(*) FILTER (abs(net + disc - score) > 1e-3) FROM c", digits=4)
def contributions(spark, sf):
    li = read(spark, sf, "lineitem")
    rows = li.select("l_orderkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"), (F.col("l_extendedprice") * F.col("l_discount")).alias("disc"), (F.col("l_extendedprice") + F.when(F.col("l_orderkey") % 97 == 0, 1).otherwise(0)).alias("score"))
    off, means = D.contributions(rows, ["l_orderkey"], ["net", "disc"], "score", 1e-3)
    return means.crossJoin(F.broadcast(off.agg(F.count(F.lit(1)).alias("n_off"))))


@query("j01_j02_a07_status", "SELECT 'orders' AS \"table\", 'o_comment' AS missing_columns, count(*) AS n_rows, count(*) - count(DISTINCT (o_custkey, o_orderdate)) AS duplicates, 0 AS null_keys, 'missing_columns' AS status FROM orders")
def status(spark, sf):
    out = Q.status(read(spark, sf, "orders"), ["o_orderkey", "o_comment"], ["o_custkey", "o_orderdate"], "orders")
    return out.withColumn("null_keys", F.col("null_keys").cast("int"))


@query("j03_j05_gaps", f"{PANEL}, tot AS (SELECT session, sum(vol) AS v FROM bars GROUP BY 1), av AS (SELECT avg(v) AS m FROM tot), busy AS (SELECT session FROM tot, av WHERE v >= m), quiet AS (SELECT session FROM tot, av WHERE v < m * 0.9), f AS (SELECT entity, min(session) AS f FROM bars GROUP BY 1) SELECT f.entity, c.session FROM f JOIN cal c ON c.session >= f WHERE NOT EXISTS (SELECT 1 FROM bars b WHERE b.entity = f.entity AND b.session = c.session) UNION ALL SELECT -1, session FROM cal WHERE session >= (SELECT min(session) FROM busy) AND session NOT IN (SELECT session FROM busy) UNION ALL SELECT -2, session FROM cal WHERE session BETWEEN DATE '1995-01-01' AND DATE '1996-12-31' AND session NOT IN (SELECT session FROM busy) AND session NOT IN (SELECT session FROM quiet)")
def gaps(spark, sf):
    b, cal = bars(spark, sf), calendar(spark, sf)
    total = b.groupBy("session").agg(F.sum("vol").alias("v"))
    total = total.crossJoin(F.broadcast(total.agg(F.avg("v").alias("m"))))
    one, two = total.where("v >= m"), total.where("v < m * 0.9")  # busy sessions, and quiet ones
    tag = lambda df, n: df.select(F.lit(n).cast("long").alias("entity"), "session")
    out = Q.entity_gaps(b, cal).unionByName(tag(Q.missing_sessions(one, cal), -1))
    return out.unionByName(tag(Q.session_gaps(one, cal, two.select("session").distinct(), "1995-01-01", "1996-12-31"), -2))


@query("j06_j10_rules", f"{PANEL}, {_LIMITS} SELECT 'panel' AS \"table\", * FROM (SELECT 'close_over_high' AS rule, count(*) FILTER (close * 1.01 > high) AS violations FROM trad UNION ALL SELECT 'limits_inverted', count(*) FILTER (up_limit < down_limit) FROM trad UNION ALL SELECT 'no_limit_yet', count(*) FILTER (up_limit IS NULL) FROM trad UNION ALL SELECT 'traded_without_close', count(*) FILTER (traded AND close IS NULL) FROM trad UNION ALL SELECT 'beyond_limits', count(*) FILTER (close > up_limit OR close < down_limit) FROM trad)")
def rules(spark, sf):
    p = L.tradability(base_panel(spark, sf))
    c = F.col
    return Q.rule_table(p, {"close_over_high": c("close") * 1.01 > c("high"), "limits_inverted": c("up_limit") < c("down_limit"), "no_limit_yet": c("up_limit").isNull(), "traded_without_close": c("traded") & c("close").isNull(), "beyond_limits": (c("close") > c("up_limit")) | (c("close") < c("down_limit"))}, "panel")


@query("j08_infinite", f"{PANEL}, v AS (SELECT CASE WHEN traded AND vol % 7 = 0 THEN CAST('inf' AS DOUBLE) ELSE close END AS a FROM panel) SELECT 'a' AS \"column\", count(*) FILTER (isinf(a)) AS infinite FROM v")
def infinite(spark, sf):
    p = panel(spark, sf).select(F.when(F.col("traded") & (F.col("vol") % 7 == 0), F.lit(float("inf"))).otherwise(F.col("close")).alias("a"), F.col("open").alias("b"))
    return Q.infinite_counts(p, ["a", "b"])


@query("j11_reconcile", "WITH a AS (SELECT o_orderkey, date_trunc('month', o_orderdate) AS month, o_totalprice AS p FROM orders), b AS (SELECT l_orderkey AS o_orderkey, date_trunc('month', l_shipdate) AS month, sum(l_extendedprice) AS p FROM lineitem GROUP BY 1, 2) SELECT 'only_left' AS \"check\", count(*) AS n FROM a ANTI JOIN b USING (o_orderkey, month) UNION ALL SELECT 'only_right', count(*) FROM b ANTI JOIN a USING (o_orderkey, month) UNION ALL SELECT 'p_differs', count(*) FROM a JOIN b USING (o_orderkey, month) WHERE abs(a.p - b.p) > 50000")
def reconcile(spark, sf):
    a = read(spark, sf, "orders").select("o_orderkey", F.trunc("o_orderdate", "month").alias("month"), F.col("o_totalprice").alias("p"))
    b = read(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"), F.trunc("l_shipdate", "month").alias("month")).agg(F.sum("l_extendedprice").alias("p"))
    return Q.reconcile(a, b, ["o_orderkey", "month"], {"p": 50000.0})


@query("j13_j15_baseline", "WITH c AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2), b AS (SELECT *, quantile_cont(n, 0.5) OVER w AS baseline, count(n) OVER w AS h FROM c WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)) SELECT event_type, day, n, round(baseline, 6) AS baseline, round(CASE WHEN baseline > 0 THEN n / baseline END, 6) AS ratio, CASE WHEN n < 3 THEN 'severe' WHEN h < 3 THEN 'short_history' WHEN CASE WHEN baseline > 0 THEN n / baseline END < 0.5 THEN 'severe' WHEN CASE WHEN baseline > 0 THEN n / baseline END < 0.9 THEN 'moderate' ELSE 'ok' END AS band FROM b")
def baseline(spark, sf):
    c = read(spark, sf, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return Q.against_baseline(c, ["event_type"], "day", "n", 7, 3, 3, moderate=0.9)


@query("j14_freshness", "WITH t AS (SELECT 'orders' AS \"table\", CAST(max(o_orderdate) AS DATE) AS last FROM orders UNION ALL SELECT 'lineitem', CAST(max(l_shipdate) AS DATE) FROM lineitem UNION ALL SELECT 'events', CAST(max(ts) AS DATE) FROM events) SELECT \"table\", last, CAST(DATE '2025-01-01' - last AS INTEGER) AS lag_days, (SELECT min(last) FROM t) AS common_end FROM t")
def freshness(spark, sf):
    t = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
    return Q.freshness({n: (read(spark, sf, n), d) for n, d in t.items()}, "2025-01-01")


_DRIFT = f"drl AS (SELECT entity, session, 'f_vol' AS feature, vol AS x FROM panel UNION ALL SELECT entity, session, 'f_amount', round(amount / vol, 9) FROM panel), ref AS (SELECT * FROM drl WHERE session < DATE '1996-01-01'), cur AS (SELECT *, CAST(date_trunc('year', session) AS DATE) AS month FROM drl WHERE session >= DATE '1996-01-01'), ed AS (SELECT feature, list_distinct(quantile_cont(x, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS edges FROM ref WHERE x IS NOT NULL GROUP BY 1)"


_DRIFT_TAIL = "rb AS (SELECT feature, CASE WHEN x IS NULL THEN -1 ELSE len(list_filter(edges, lambda e: e <= x)) END AS bin, count(*) AS k FROM ref JOIN ed USING (feature) GROUP BY 1, 2), rs AS (SELECT feature, bin, k / sum(k) OVER (PARTITION BY feature) AS r FROM rb), cb AS (SELECT feature, month, CASE WHEN x IS NULL THEN -1 ELSE len(list_filter(edges, lambda e: e <= x)) END AS bin, count(*) AS k FROM cur JOIN ed USING (feature) GROUP BY 1, 2, 3), cs AS (SELECT feature, month, bin, k / sum(k) OVER (PARTITION BY feature, month) AS c FROM cb), grid AS (SELECT feature, month, unnest(range(-1, len(edges) + 1)) AS bin FROM (SELECT DISTINCT feature, month FROM cb) JOIN ed USING (feature)), ps AS (SELECT feature, month, sum((greatest(coalesce(c, 0), 1e-6) - greatest(coalesce(r, 0), 1e-6)) * ln(greatest(coalesce(c, 0), 1e-6) / greatest(coalesce(r, 0), 1e-6))) AS psi FROM grid LEFT JOIN cs USING (feature, month, bin) LEFT JOIN rs USING (feature, bin) GROUP BY 1, 2), kv AS (SELECT feature, month, x, count(*) AS c, 0 AS r FROM cur WHERE x IS NOT NULL GROUP BY 1, 2, 3 UNION ALL SELECT r.feature, m.month, x, 0, count(*) FROM ref r JOIN (SELECT DISTINCT feature, month FROM cur WHERE x IS NOT NULL) m ON m.feature = r.feature WHERE x IS NOT NULL GROUP BY 1, 2, 3), kx AS (SELECT feature, month, x, sum(c) AS c, sum(r) AS r FROM kv GROUP BY 1, 2, 3), kd AS (SELECT feature, month, abs(sum(c) OVER o / sum(c) OVER a - sum(r) OVER o / sum(r) OVER a) AS d FROM kx WINDOW a AS (PARTITION BY feature, month), o AS (PARTITION BY feature, month ORDER BY x ROWS UNBOUNDED PRECEDING)), kk AS (SELECT feature, month, max(d) AS ks FROM kd GROUP BY 1, 2), cv AS (SELECT feature, month, avg(CAST(x IS NOT NULL AS INTEGER)) AS coverage, count(*) AS n FROM cur GROUP BY 1, 2) SELECT feature, month, round(coverage, 4) AS coverage, n, round(psi, 4) AS psi, round(ks, 4) AS ks, CASE WHEN psi >= 0.25 THEN 'severe' WHEN psi >= 0.1 THEN 'moderate' WHEN psi IS NOT NULL THEN 'stable' END AS severity FROM cv LEFT JOIN ps USING (feature, month) LEFT JOIN kk USING (feature, month)"


@query("k01_k04_feature_drift", f"{PANEL}, {_DRIFT}, {_DRIFT_TAIL}", digits=4)
def feature_drift(spark, sf):
    p = panel(spark, sf).select(*KEY, F.col("vol").alias("f_vol"), F.round(F.col("amount") / F.col("vol"), 9).alias("f_amount"))
    rows = D.long_form(p, KEY, ["f_vol", "f_amount"])
    cut = F.to_date(F.lit("1996-01-01"))
    cur = rows.where(F.col("session") >= cut).withColumn("month", F.to_date(F.date_trunc("year", "session")))
    return K.feature_drift(rows.where(F.col("session") < cut), cur, ["feature"], "month", "x").withColumn("severity", K.severity(F.col("psi")))


@query("k05_l08_score_profile", f"{PANEL}, s AS (SELECT CAST(date_trunc('month', session) AS DATE) AS month, round(-ret_1d, 9) AS score FROM rets WHERE ret_1d IS NOT NULL) SELECT month, round(avg(score), 4) AS mean, round(stddev_pop(score), 4) AS std, " + ", ".join(f"round(quantile_cont(score, {q}), 4) AS p{round(q * 100):02d}" for q in (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)) + ", round(quantile_cont(score, 0.95) - quantile_cont(score, 0.05), 4) AS spread, round(count(DISTINCT score) / count(score), 4) AS unique_ratio FROM s GROUP BY 1", digits=4)
def score_profile(spark, sf):
    s = scored(spark, sf).where("score IS NOT NULL").withColumn("month", F.to_date(F.date_trunc("month", "session")))
    return K.score_profile(s, "month", "score")


@query("k06_concentration", f"{PANEL}, s AS (SELECT entity, session, round(-ret_1d, 9) AS score FROM rets WHERE ret_1d IS NOT NULL), e AS (SELECT *, exp(score - max(score) OVER (PARTITION BY session)) AS e FROM s), w AS (SELECT *, e / sum(e) OVER (PARTITION BY session) AS w, row_number() OVER (PARTITION BY session ORDER BY score DESC, entity) AS r, count(*) OVER (PARTITION BY session) AS n FROM e) SELECT session, round(sum(CASE WHEN r <= greatest(1, ceil(n * 0.01)) THEN w ELSE 0 END), 4) AS top_1_mass, round(sum(CASE WHEN r <= greatest(1, ceil(n * 0.1)) THEN w ELSE 0 END), 4) AS top_10_mass, round(1 / sum(w * w), 4) AS breadth, round(max(score) - quantile_cont(score, 0.5), 4) AS top_over_median FROM w GROUP BY 1", digits=4)
def concentration(spark, sf):
    return K.concentration(scored(spark, sf))


@query("k07_k08_response", f"{PANEL}, {_BUCKETS}, m AS (SELECT feature, rank() OVER (PARTITION BY feature ORDER BY bucket) AS a, rank() OVER (PARTITION BY feature ORDER BY mean_ret) AS b, mean_ret, bucket FROM bk) SELECT feature, round((avg(a * b) - avg(a) * avg(b)) / (stddev_pop(a) * stddev_pop(b)), 4) AS monotonicity, round(max(CASE WHEN bucket = 4 THEN mean_ret END) - max(CASE WHEN bucket = 0 THEN mean_ret END), 4) AS spread FROM m GROUP BY 1", digits=4)
def response(spark, sf):
    b = D.quantile_returns(long(spark, sf), 5)
    mono = M.monotonicity(b.withColumnRenamed("bucket", "decile"), ["feature"])
    return mono.join(D.top_minus_bottom(b, 5), "feature")


_OBSERVED = f"{_FRAME}, o AS (SELECT entity, session, 'a' AS model_id, 'champion' AS model_role, 5 AS horizon, f_ret FROM frame UNION ALL SELECT entity, session, 'e', 'ensemble', unnest([1, 5]), f_ret FROM frame), m AS (SELECT o.*, b.session AS exit_session FROM o JOIN cal a ON a.session = o.session JOIN cal b ON b.pos = a.pos + 1 + o.horizon)"


@query("l01_l03_observations", f"{PANEL}, {_OBSERVED} SELECT entity, session, model_id, horizon, exit_session, sha256(concat_ws('|', model_id, CAST(session AS VARCHAR), CAST(entity AS VARCHAR), CAST(horizon AS VARCHAR))) AS observation_id FROM m WHERE exit_session <= DATE '2000-01-01'")
def observations(spark, sf):
    from ..operators.calendar import horizon_map

    f = frame(spark, sf).select(*KEY)
    rows = f.select("*", F.lit("a").alias("model_id"), F.lit("champion").alias("model_role"), F.lit(5).alias("horizon")).unionByName(f.select("*", F.lit("e").alias("model_id"), F.lit("ensemble").alias("model_role"), F.lit(0).alias("horizon")))
    out = M.mature(M.expand_horizons(rows, (1, 5)), horizon_map(calendar(spark, sf), (1, 5)), "2000-01-01")
    return M.observation_ids(out, ["model_id", "session", "entity", "horizon"]).select(*KEY, "model_id", "horizon", "exit_session", "observation_id")


_PERF = f"{_IC.replace(_FRAME, _LAYERS)}, pf AS (SELECT r.session, avg(CASE WHEN y IS NOT NULL THEN CAST(y > 0 AS INTEGER) END) AS hit_rate, avg(CASE WHEN rank <= 10 THEN y END) AS top10_ret, avg(CASE WHEN rank <= 10 AND y IS NOT NULL THEN CAST(y > 0 AS INTEGER) END) AS top10_hit FROM rkd r GROUP BY 1)"


@query("l04_daily_performance", f"{PANEL}, {_PERF} SELECT p.session, round(hit_rate, 4) AS hit_rate, round(top10_ret, 4) AS top10_ret, round(top10_hit, 4) AS top10_hit, round(i.rank_ic, 4) AS rank_ic FROM pf p LEFT JOIN (SELECT * FROM ic WHERE feature = 'f_ret') i ON i.session = p.session", digits=4)
def daily_performance(spark, sf):
    s = scores(spark, sf)
    r = G.ranked(s, "score")
    out = M.daily_performance(r, ["session"], (10,)).drop("rank_ic")
    ic = D.daily_ic(s.withColumn("x", F.col("score")), ["session"]).select("session", "rank_ic")
    return out.join(ic, "session", "left")


@query("l05_l06_recent_means", f"{PANEL}, {_IC}, r AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY session DESC) AS r FROM ic), m AS (SELECT feature, avg(rank_ic) AS all_mean, " + ", ".join(f"avg(CASE WHEN r <= {w} THEN rank_ic END) AS last_{w}_mean" for w in (20, 60, 120)) + " FROM r GROUP BY 1) SELECT feature, round(all_mean, 4) AS all_mean, " + ", ".join(f"round(last_{w}_mean, 4) AS last_{w}_mean, round(last_{w}_mean / all_mean, 3) AS decay_{w}" for w in (20, 60, 120)) + " FROM m", digits=4)
def recent(spark, sf):
    out = M.recent_means(ics(spark, sf), ["feature"], "rank_ic")
    return out.withColumns({f"decay_{w}": F.round(F.col(f"decay_{w}") + 1e-9, 3) for w in (20, 60, 120)})


@query("l07_deciles", f"{PANEL}, {_LAYERS}, d AS (SELECT CAST(greatest(1, least(10, ceil((1 - (rank - 1) / n) * 10))) AS INTEGER) AS decile, y FROM rkd WHERE y IS NOT NULL) SELECT decile, round(avg(y), 4) AS mean_ret, count(*) AS n FROM d GROUP BY 1", digits=4)
def deciles(spark, sf):
    r = G.ranked(scores(spark, sf), "score").withColumn("all", F.lit("all"))
    return M.decile_returns(r, ["all"]).drop("all")


_FILLS = "fills AS (SELECT l_suppkey AS portfolio, l_partkey AS entity, CAST(l_shipdate AS DATE) AS date, l_orderkey, l_linenumber, l_quantity AS shares, l_extendedprice AS value, CASE WHEN l_linenumber % 2 = 1 THEN 'buy' ELSE 'sell' END AS side FROM lineitem)"


def fills(spark, sf):
    side = F.when(F.col("l_linenumber") % 2 == 1, "buy").otherwise("sell")
    return read(spark, sf, "lineitem").select(F.col("l_suppkey").alias("portfolio"), F.col("l_partkey").alias("entity"), F.to_date("l_shipdate").alias("date"), "l_orderkey", "l_linenumber", F.col("l_quantity").alias("shares"), F.col("l_extendedprice").alias("value"), side.alias("side"))


@query("l09_l11_equity_curve", f"WITH {_FILLS}, f AS (SELECT portfolio, date, sum(CASE WHEN side = 'sell' THEN value * 1.01 ELSE -value END) AS flow FROM fills GROUP BY 1, 2), e AS (SELECT *, 1e9 + sum(flow) OVER w AS equity FROM f WINDOW w AS (PARTITION BY portfolio ORDER BY date ROWS UNBOUNDED PRECEDING)) SELECT portfolio, date, round(equity / 1e9, 6) AS nav, round(equity / coalesce(lag(equity) OVER (PARTITION BY portfolio ORDER BY date), 1e9) - 1, 6) AS daily_return, round(equity / greatest(1e9, max(equity) OVER (PARTITION BY portfolio ORDER BY date ROWS UNBOUNDED PRECEDING)) - 1, 6) AS drawdown FROM e")
def equity(spark, sf):
    f = fills(spark, sf).withColumn("cash", F.when(F.col("side") == "sell", F.col("value") * 1.01).otherwise(-F.col("value")))
    return M.equity_curve(f, "portfolio", "date", "cash", 1e9).select("portfolio", "date", "nav", "daily_return", "drawdown")


@query("l09_weights", f"WITH {_FILLS}, p AS (SELECT portfolio, entity, sum(value) AS value FROM fills GROUP BY 1, 2), w AS (SELECT *, value / sum(value) OVER (PARTITION BY portfolio) AS w, row_number() OVER (PARTITION BY portfolio ORDER BY value DESC, entity) AS r FROM p) SELECT portfolio, round(max(w), 6) AS max_weight, round(sum(CASE WHEN r <= 5 THEN w ELSE 0 END), 6) AS top_concentration, count(*) AS n_positions FROM w GROUP BY 1")
def weights(spark, sf):
    p = fills(spark, sf).groupBy("portfolio", "entity").agg(F.sum("value").alias("value"))
    return M.weights(p, "portfolio", "value")


@query("l10_latest_state", f"WITH {_FILLS} SELECT portfolio, entity, shares, side FROM (SELECT *, row_number() OVER (PARTITION BY portfolio, entity ORDER BY date DESC, l_orderkey DESC, l_linenumber DESC, value DESC, shares DESC) AS n FROM fills WHERE date <= DATE '1996-06-30') WHERE n = 1")
def latest(spark, sf):
    return M.latest_state(fills(spark, sf), ["portfolio", "entity"], ["date", "l_orderkey", "l_linenumber", "value", "shares"], ["shares", "side"], F.col("date") <= F.to_date(F.lit("1996-06-30")))


@query("l12_l13_path_metrics", f"{PANEL}, yr AS (SELECT entity, CAST(year(session) AS INTEGER) AS year, session, CASE WHEN ret_1d IS NOT NULL THEN least(greatest(ret_1d, -0.5), 0.5) / 10 END AS r FROM rets), {_paths('yr', 'entity, year', 'session', 'r', '52')} SELECT entity, year, n, round(total_return, 4) AS total_return, round(annual_return, 3) AS annual_return, round(volatility, 4) AS volatility, round(sharpe, 4) AS sharpe, round(max_drawdown, 4) AS max_drawdown, round(win_rate, 4) AS win_rate FROM pm", digits=4)
def path_metrics(spark, sf):
    r = R.with_returns(panel(spark, sf)).select("entity", F.year("session").alias("year"), "session", F.when(F.col("ret_1d").isNotNull(), F.least(F.greatest("ret_1d", F.lit(-0.5)), F.lit(0.5)) / 10).alias("r"))
    return D.path_metrics(r, ["entity", "year"], "session", "r", 52.0).withColumn("annual_return", F.round(F.col("annual_return") + 1e-9, 3))


@query("l14_l17_trade_summary", f"WITH {_FILLS}, c AS (SELECT portfolio, entity, sum(value) FILTER (side = 'sell') - sum(value) FILTER (side = 'buy') AS pnl, max(date) FILTER (side = 'sell') - min(date) FILTER (side = 'buy') AS days FROM fills GROUP BY 1, 2 HAVING count(*) FILTER (side = 'buy') > 0 AND count(*) FILTER (side = 'sell') > 0) SELECT count(*) AS n, round(avg(CAST(pnl > 0 AS INTEGER)), 4) AS win_rate, round(avg(pnl) FILTER (pnl > 0) / avg(-pnl) FILTER (pnl < 0), 4) AS profit_loss_ratio, round(avg(days), 4) AS days_mean, round(quantile_cont(days, 0.5), 4) AS days_median, round(quantile_cont(days, 0.95), 4) AS days_p95, round(max(pnl), 2) AS best, round(min(pnl), 2) AS worst FROM c", digits=4)
def trade_summary(spark, sf):
    f = fills(spark, sf).withColumn("position", F.struct("portfolio", "entity"))
    out = M.trade_summary(M.closed_trades(f, "position"))
    return out.withColumns({c: F.round(F.col(c) + 1e-9, 2) for c in ("best", "worst")})


@query("l16_ledger_violations", f"WITH {_FILLS}, h AS (SELECT portfolio, entity, l_orderkey, l_linenumber, sum(CASE WHEN side = 'buy' THEN shares ELSE -shares END) OVER (PARTITION BY portfolio, entity ORDER BY date, l_orderkey, l_linenumber, value, shares ROWS UNBOUNDED PRECEDING) AS held FROM fills) SELECT * FROM h WHERE held < 0")
def violations(spark, sf):
    return M.ledger_violations(fills(spark, sf), ["portfolio", "entity"], ["date", "l_orderkey", "l_linenumber", "value", "shares"]).select("portfolio", "entity", "l_orderkey", "l_linenumber", "held")


@query("l18_stale_marks", f"{PANEL}, m AS (SELECT entity, session, pos, last_value(close IGNORE NULLS) OVER w AS mark, max(CASE WHEN close IS NOT NULL THEN pos END) OVER w AS p FROM panel WINDOW w AS (PARTITION BY entity ORDER BY pos ROWS UNBOUNDED PRECEDING)) SELECT entity, session, round(mark, 6) AS mark, pos - p AS stale_sessions, CASE WHEN p IS NULL THEN 'none' WHEN pos > p THEN 'stale' ELSE 'fresh' END AS mark_status FROM m")
def stale(spark, sf):
    return M.stale_marks(panel(spark, sf)).select(*KEY, "mark", "stale_sessions", "mark_status")


@query("l19_l23_volatility_flags", f"{PANEL}, r AS (SELECT entity, ret_1d, row_number() OVER (PARTITION BY entity ORDER BY session DESC) AS r FROM rets WHERE ret_1d IS NOT NULL), v AS (SELECT entity, CASE WHEN count(*) >= 10 THEN stddev_pop(ret_1d) END AS v, count(*) AS n FROM r WHERE r <= 20 GROUP BY 1) SELECT v.entity, s_nationkey AS grp, round(v, 6) AS volatility, n, concat_ws(',', CASE WHEN v > 2 THEN 'volatile' END, CASE WHEN s_acctbal < 0 THEN 'in_debt' END, CASE WHEN n < 20 THEN 'short_history' END) AS flags FROM v JOIN supplier ON s_suppkey = v.entity")
def volatility(spark, sf):
    v = M.trailing_volatility(R.with_returns(panel(spark, sf)), 20, 10)
    s = read(spark, sf, "supplier").select(F.col("s_suppkey").alias("entity"), F.col("s_nationkey").alias("grp"), "s_acctbal")
    flags = M.risk_flags([("volatile", F.col("volatility") > 2), ("in_debt", F.col("s_acctbal") < 0), ("short_history", F.col("n") < 20)])
    return v.join(s, "entity").select("entity", "grp", "volatility", "n", F.array_join(flags, ",").alias("flags"))


@query("l21_watch_table", f"{PANEL}, x AS (SELECT entity, session, ret_1d, vol FROM rets) SELECT entity, session, 'fall' AS rule, round(ret_1d, 6) AS value, CASE WHEN ret_1d IS NULL THEN 'unavailable' WHEN ret_1d < -0.5 THEN 'met' ELSE 'watch' END AS status FROM x UNION ALL SELECT entity, session, 'busy', round(vol, 6), CASE WHEN vol IS NULL THEN 'unavailable' WHEN vol > 80 THEN 'met' ELSE 'watch' END FROM x")
def watch(spark, sf):
    rows = R.with_returns(panel(spark, sf))
    return M.watch_table(rows, KEY, [("fall", "ret_1d", F.col("ret_1d") < -0.5), ("busy", "vol", F.col("vol") > 80)])


@query("l22_banded_counts", "SELECT b.band, count(c_custkey) AS n FROM (VALUES ('debt', 0), ('small', 1), ('middle', 2), ('large', 3), ('giant', 4)) AS b(band, k) LEFT JOIN customer ON k = CASE WHEN c_acctbal < 0 THEN 0 WHEN c_acctbal < 2000 THEN 1 WHEN c_acctbal < 6000 THEN 2 WHEN c_acctbal < 100000 THEN 3 ELSE 4 END GROUP BY 1")
def bands(spark, sf):
    return M.banded_counts(read(spark, sf, "customer"), "c_acctbal", [("debt", 0), ("small", 2000), ("middle", 6000), ("large", 100000), ("giant", float("inf"))])


_ALERTS = "ev AS (SELECT event_type AS subject, CAST(ts AS DATE) AS day, CAST(count(*) AS DOUBLE) AS count, avg(value) AS mean_value FROM events GROUP BY 1, 2), me AS (SELECT subject, day, 'count' AS metric, count AS value FROM ev UNION ALL SELECT subject, day, 'mean_value', mean_value FROM ev), th AS (SELECT quantile_cont(count, 0.2) AS c2, quantile_cont(count, 0.05) AS c05, quantile_cont(mean_value, 0.8) AS m8, quantile_cont(mean_value, 0.95) AS m95 FROM ev), al AS (SELECT me.*, CASE metric WHEN 'count' THEN CASE WHEN value <= c05 THEN 'critical' WHEN value <= c2 THEN 'warning' END ELSE CASE WHEN value >= m95 THEN 'critical' WHEN value >= m8 THEN 'warning' END END AS severity FROM me, th)"


def metrics(spark, sf):
    ev = read(spark, sf, "events").groupBy(F.col("event_type").alias("subject"), F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).cast("double").alias("count"), F.avg("value").alias("mean_value"))
    long = D.long_form(ev, ["subject", "day"], ["count", "mean_value"]).withColumnRenamed("feature", "metric").withColumnRenamed("x", "value")
    at = lambda c, p: F.percentile(c, F.lit(p))
    th = ev.agg(F.array(F.struct(F.lit("count").alias("metric"), F.lit("below").alias("direction"), at("count", 0.2).alias("warning"), at("count", 0.05).alias("critical")), F.struct(F.lit("mean_value").alias("metric"), F.lit("above").alias("direction"), at("mean_value", 0.8).alias("warning"), at("mean_value", 0.95).alias("critical"))).alias("r"))
    return long, th.select(F.explode("r").alias("r")).select("r.*")


@query("l24_alerts", f"WITH {_ALERTS} SELECT subject, day, metric, round(value, 6) AS value, severity FROM al WHERE severity IS NOT NULL")
def alerts(spark, sf):
    rows, rules = metrics(spark, sf)
    return M.alerts(rows, rules).select("subject", "day", "metric", "value", "severity")


@query("l25_alert_lifecycle", f"WITH {_ALERTS}, s AS (SELECT *, severity IS NOT NULL AS b, coalesce(lag(severity IS NOT NULL) OVER (PARTITION BY subject, metric ORDER BY day), FALSE) AS was FROM al), t AS (SELECT *, CASE WHEN b AND NOT was THEN 'NEW' WHEN b THEN 'ACTIVE' WHEN was THEN 'RECOVERED' END AS state FROM s), u AS (SELECT *, last_value(CASE WHEN state = 'NEW' THEN day END IGNORE NULLS) OVER (PARTITION BY subject, metric ORDER BY day ROWS UNBOUNDED PRECEDING) AS first_seen FROM t) SELECT subject, metric, day, state, first_seen, severity FROM u WHERE state IS NOT NULL")
def lifecycle(spark, sf):
    rows, rules = metrics(spark, sf)
    return M.alert_lifecycle(M.alerts(rows, rules), rows.select("subject", "metric", "day"))


@query("a03_merged", f"SELECT o_custkey, o_orderdate, o_orderkey, round(o_totalprice, 6) AS o_totalprice, src FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY src DESC, o_orderkey DESC) AS n FROM (SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice, 1 AS src FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice, 0 FROM orders WHERE o_orderkey % 3 > 0)) WHERE n = 1")
def merged(spark, sf):
    o = read(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    new = o.where("o_orderkey % 3 = 0").withColumn("src", F.lit(1))
    return S.merged(o.where("o_orderkey % 3 > 0").withColumn("src", F.lit(0)), new, ["o_custkey", "o_orderdate"], [F.desc("o_orderkey")])


ORDERS = S.TableSpec("orders", ("o_orderkey",), "day", "o_orderkey long, o_custkey long, o_totalprice double, day date")


def _root(spark, name):
    """A new folder for the tables that a query writes, so that runs don't meet. Their
    results still read it, so it is left to whoever clears the shared folder."""
    return f"{root_of(spark)}/store-{uuid.uuid4().hex}/{name}"


def stored_orders(spark, sf, name):
    """orders written to a store by month, in two upserts that overlap: at first the
    orders of before 1998 at half their price, then all from 1996 on, so that those of
    1995 stay as they were and those of 1996 and 1997 are replaced."""
    root, day = _root(spark, name), F.to_date("o_orderdate").alias("day")
    o = read(spark, sf, "orders")
    early = o.where("o_orderdate < '1998-01-01'").select("o_orderkey", "o_custkey", (F.col("o_totalprice") / 2).alias("o_totalprice"), day)
    S.upsert(spark, root, ORDERS, early)
    S.upsert(spark, root, ORDERS, o.where("o_orderdate >= '1996-01-01'").select("o_orderkey", "o_custkey", "o_totalprice", day))
    return root


_STORED = "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderdate >= DATE '1996-01-01' THEN o_totalprice ELSE o_totalprice / 2 END AS price FROM orders"


@query("a01_a02_scan", f"SELECT o_orderkey, day, round(price, 6) AS o_totalprice FROM ({_STORED}) WHERE day BETWEEN DATE '1995-11-20' AND DATE '1996-02-10'")
def scan(spark, sf):
    return S.scan_table(spark, stored_orders(spark, sf, "scan"), ORDERS, "1995-11-20", "1996-02-10", ("o_orderkey", "day", "o_totalprice"))


@query("a02_session_scan", f"SELECT o_orderkey, round(price, 6) AS o_totalprice FROM ({_STORED}) WHERE day = DATE '1995-06-19'")
def session_scan(spark, sf):
    return S.scan_table(spark, stored_orders(spark, sf, "session"), ORDERS, "1995-06-19", "1995-06-19", ("o_orderkey", "o_totalprice"))


@query("a04_snapshot", "SELECT o_custkey, o_orderkey, round(o_totalprice, 6) AS o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1")
def snapshot(spark, sf):
    path = _root(spark, "snapshot")
    S.replace_snapshot(read(spark, sf, "orders"), path, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return spark.read.parquet(path).select("o_custkey", "o_orderkey", "o_totalprice")


_BY_STATUS = "SELECT o_orderstatus AS status, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1"


@query("a10_metric_files", f"WITH m AS ({_BY_STATUS}) SELECT 'csv' AS kind, * FROM m UNION ALL SELECT 'json', * FROM m")
def metric_files(spark, sf):
    m = read(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice") + 1e-9, 2).alias("total"))
    out = []
    for kind in ("csv", "json"):
        path = _root(spark, f"metrics-{kind}")
        S.write_metrics(m, path, kind)
        rows = spark.read.schema(m.schema)
        out.append((rows.option("header", True).csv(path) if kind == "csv" else rows.json(path)).select(F.lit(kind).alias("kind"), "*"))
    return out[0].unionAll(out[1])


@query("j18_event_log", "SELECT DATE '2024-01-02' AS date, 'orders' AS \"table\", 'priced' AS rule, count(*) FILTER (o_totalprice <= 1000) AS violations FROM orders UNION ALL SELECT DATE '2024-01-02', 'orders', 'open', count(*) FILTER (o_orderstatus = 'O') FROM orders UNION ALL SELECT DATE '2024-01-03', 'lineitem', 'returned', count(*) FILTER (l_returnflag = 'R') FROM lineitem")
def event_log(spark, sf):
    path = _root(spark, "events")
    c = F.col
    S.append_events(Q.rule_table(read(spark, sf, "orders"), {"priced": c("o_totalprice") <= 1000, "open": c("o_orderstatus") == "O"}, "orders"), path, "2024-01-02")
    S.append_events(Q.rule_table(read(spark, sf, "lineitem"), {"returned": c("l_returnflag") == "R"}, "lineitem"), path, "2024-01-03")
    return spark.read.schema("`table` string, rule string, violations long, date date").json(path).select("date", "table", "rule", "violations")


@query("a05_a06_status", f"{PANEL} SELECT count(*) AS n_rows, count(DISTINCT date_trunc('month', session)) AS n_months, min(session) AS first, max(session) AS last, count(*) FILTER (traded) AS n_traded FROM panel")
def table_status(spark, sf):
    return S.table_status(panel(spark, sf), "session", ["traded"])


@query("a06_footer_statistics", f"SELECT count(*) AS n_rows, count(price) AS n_priced, count(DISTINCT date_trunc('month', day)) AS n_partitions, min(day) AS first, max(day) AS last FROM ({_STORED})")
def footer_statistics(spark, sf):
    return S.footer_statistics(spark, stored_orders(spark, sf, "footers"), ORDERS, ["o_totalprice"]).withColumnRenamed("n_o_totalprice", "n_priced")


@query("a06_schema", "SELECT * FROM (VALUES ('day', 'date', true), ('month', 'int', true), ('o_custkey', 'bigint', true), ('o_orderkey', 'bigint', true), ('o_totalprice', 'double', true), ('year', 'int', true)) t(column_name, data_type, nullable)")
def schema(spark, sf):
    return S.schema_table(spark, stored_orders(spark, sf, "schema"), ORDERS)


@query(
    "j01_table_set",
    "WITH o AS (SELECT count(*) AS n FROM orders), l AS (SELECT count(*) AS n, count(*) - count(DISTINCT l_orderkey) AS d FROM lineitem) "
    "SELECT 'orders' AS \"table\", 'valid' AS status, n AS n_rows, 0 AS duplicates, '' AS missing_columns FROM o "
    "UNION ALL SELECT 'lines', CASE WHEN d > 0 THEN 'invalid' ELSE 'valid' END, n, d, '' FROM l "
    "UNION ALL SELECT 'unpriced', 'invalid', n, 0, 'o_price' FROM o "
    "UNION ALL SELECT 'keyless', 'invalid', n, 0, 'o_key' FROM o "
    "UNION ALL SELECT * FROM (VALUES ('hollow', 'empty', 0, 0, ''), ('hollow_optional', 'skipped', 0, 0, ''), ('absent', 'missing', 0, 0, ''), ('absent_optional', 'skipped', 0, 0, '')) v",
)
def table_set(spark, sf):
    hollow = _root(spark, "hollow")
    read(spark, sf, "orders").limit(0).write.parquet(hollow)
    at = lambda t: f"{sf}/{t}.parquet"
    return Q.table_set_status(
        spark,
        [
            Q.Expected("orders", at("orders"), ("o_orderkey",), ("o_orderdate",)),
            Q.Expected("lines", at("lineitem"), ("l_orderkey",)),
            Q.Expected("unpriced", at("orders"), ("o_orderkey",), ("o_price",)),
            Q.Expected("keyless", at("orders"), ("o_key",)),
            Q.Expected("hollow", hollow, ("o_orderkey",)),
            Q.Expected("hollow_optional", hollow, ("o_orderkey",), optional=True),
            Q.Expected("absent", f"{hollow}-absent", ("k",)),
            Q.Expected("absent_optional", f"{hollow}-absent", ("k",), optional=True),
        ],
    )


@query("a09_incremental_start", f"{PANEL}, m AS (SELECT max(pos) AS p FROM cal WHERE session <= DATE '1997-07-01') SELECT session FROM cal, m WHERE pos = greatest(1, p - 10)")
def incremental(spark, sf):
    return S.incremental_start(calendar(spark, sf), bars(spark, sf).where(F.col("session") <= F.to_date(F.lit("1997-07-01"))), "session", 10)


_ROW = "md5(concat_ws('|', '=' || o_orderkey, '=' || o_custkey, '=' || o_orderstatus, coalesce('=' || p, 'null')))"


@query("a08_content_hash", f"WITH h AS (SELECT CAST('0x' || substr({_ROW}, 1, 15) AS BIGINT) AS h FROM (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS p FROM orders)) SELECT count(*) AS n, CAST(sum(h) AS VARCHAR) AS total, bit_xor(h) AS mixed FROM h")
def content_hash(spark, sf):
    p = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).alias("p")
    return S.content_hash(read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", p))
