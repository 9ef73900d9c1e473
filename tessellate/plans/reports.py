"""Queries over whole reports: evaluations, drift, ledgers, samples (D, I, J, K, L)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import calendar as C
from ..operators import diagnostics as D
from ..operators import drift as K
from ..operators import monitor as M
from ..operators import quality as Q
from ..operators import ranks as G
from ..operators import rolling as R
from .base import PANEL, QUERIES, ORACLE_SQL, calendar, panel, pct, query, read
from .features import scored
from .metrics import _BUCKETS, _DRIFT, _DRIFT_TAIL, _FILLS, _IC, _FRAME, _LAYERS, _NDCG, feature_drift, fills, frame, ics, long, scores
from .labelling import labels

KEY = ["entity", "session"]


@query(
    "i02_i06_ic_statistics",
    f"{PANEL}, {_IC}, c AS (SELECT feature, avg(CAST(x IS NOT NULL AS INTEGER)) AS coverage FROM long GROUP BY 1), s AS (SELECT feature, count(*) AS days, avg(ic) AS pm, stddev_samp(ic) AS ps, avg(rank_ic) AS rm, stddev_samp(rank_ic) AS rs, avg(CAST(rank_ic > 0 AS INTEGER)) AS positive_ratio FROM ic GROUP BY 1) "
    "SELECT feature, days, round(coverage, 4) AS coverage, round(1 - coverage, 4) AS missing_ratio, round(pm, 4) AS pearson_mean, round(ps, 4) AS pearson_std, round(CASE WHEN ps > 1e-12 THEN pm / ps END, 4) AS pearson_icir, round(rm, 4) AS rank_mean, round(rs, 4) AS rank_std, round(CASE WHEN rs > 1e-12 THEN rm / rs END, 4) AS rank_icir, round(positive_ratio, 4) AS positive_ratio, row_number() OVER (ORDER BY round(abs(rm) * sqrt(coverage), 6) DESC, feature) AS place FROM s JOIN c USING (feature) WHERE coverage >= 0.5 AND days >= 100",
    digits=4,
)
def ic_statistics(spark, sf):
    rows = long(spark, sf)
    cover = rows.groupBy("feature").agg(F.avg(F.col("x").isNotNull().cast("double")).alias("coverage"))
    stats = D.ic_statistics(D.daily_ic(rows), cover).withColumn("score", F.round(F.abs("rank_mean") * F.sqrt("coverage") + 1e-9, 6))
    return D.eligible_features(stats, 0.5, 100, "score").drop("score")


_TOPS = ", ".join(f"avg(CASE WHEN rank <= {k} THEN y END) AS top{k}_ret" for k in (10, 20, 50))


@query(
    "i16_i18_evaluation",
    f"{PANEL}, {_IC.replace(_FRAME, _LAYERS)}{_NDCG.replace(_FRAME, '')}, tp AS (SELECT session, {_TOPS} FROM rkd GROUP BY 1), g AS (SELECT session, max(by_) AS b FROM frame GROUP BY 1), dd AS (SELECT t.*, i.rank_ic, CASE WHEN best > 0 THEN dcg / best ELSE 0 END AS ndcg, CASE WHEN b > 0.01 THEN 'bull' WHEN b < -0.01 THEN 'bear' WHEN b IS NOT NULL THEN 'neutral' END AS regime FROM tp t JOIN (SELECT * FROM ic WHERE feature = 'f_ret') i ON i.session = t.session JOIN nd ON nd.session = t.session LEFT JOIN g ON g.session = t.session), "
    "br AS (SELECT *, 'overall' AS period_type, 'all' AS period FROM dd UNION ALL SELECT *, 'year', strftime(session, '%Y') FROM dd UNION ALL SELECT *, 'month', strftime(session, '%Y%m') FROM dd UNION ALL SELECT *, 'regime', regime FROM dd WHERE regime IS NOT NULL) SELECT period_type, period, count(*) AS days, "
    + ", ".join(f"round(avg({v}), 4) AS {v}_mean, round(CASE WHEN stddev_samp({v}) > 1e-12 THEN avg({v}) / stddev_samp({v}) END, 3) AS {v}_ratio, round(avg(CASE WHEN {v} IS NOT NULL THEN CAST({v} > 0 AS INTEGER) END), 4) AS {v}_positive" for v in ("rank_ic", "ndcg", "top10_ret", "top20_ret", "top50_ret"))
    + " FROM br GROUP BY 1, 2",
    digits=4,
)
def evaluation(spark, sf):
    s = scores(spark, sf)
    values = ("rank_ic", "ndcg", "top10_ret", "top20_ret", "top50_ret")
    quantiles = labels(spark, sf).where("horizon = 1").select(*KEY, "label_quantile")
    daily = M.daily_performance(G.ranked(s, "score"), ["session"], (10, 20, 50)).drop("rank_ic")
    daily = daily.join(D.daily_ic(s.withColumn("x", F.col("score")), ["session"]).select("session", "rank_ic"), "session").join(D.ndcg(s.join(quantiles, KEY), "label_quantile", 10), "session")
    from .metrics import frame

    regimes = frame(spark, sf).groupBy("session").agg(D.regime(F.max("by_"), 0.01).alias("regime"))
    out = D.evaluate_periods(daily, D.period_bridge(daily, regimes), values)
    return out.withColumns({f"{v}_ratio": F.round(F.col(f"{v}_ratio") + 1e-9, 3) for v in values})


@query("d15_comparison", f"{PANEL}, {_FRAME} SELECT session, count(*) AS n, count(y) AS labelled, round(avg(y) FILTER (a > b), 4) AS challenger_higher, round(avg(y) FILTER (a <= b), 4) AS champion_higher FROM (SELECT session, y, round(f_ret, 9) AS a, round(f_vol / 20 - 1, 9) AS b FROM frame WHERE f_ret IS NOT NULL) GROUP BY 1", digits=4)
def comparison(spark, sf):
    from .metrics import frame

    f = frame(spark, sf)
    both = D.comparison_frame(f.where("f_ret IS NOT NULL").select(*KEY, F.round("f_ret", 9).alias("score")), f.select(*KEY, F.round(F.col("f_vol") / 20 - 1, 9).alias("score")), f)
    higher = F.col("challenger") > F.col("champion")
    return both.groupBy("session").agg(F.count(F.lit(1)).alias("n"), F.count("y").alias("labelled"), F.avg(F.when(higher, F.col("y"))).alias("challenger_higher"), F.avg(F.when(~higher, F.col("y"))).alias("champion_higher"))


_SCORES = f"sp AS (SELECT entity, session, CAST(date_trunc('month', session) AS DATE) AS month, round(-ret_1d, 9) AS score FROM rets WHERE ret_1d IS NOT NULL), sq AS (SELECT *, {pct('score', 'session')} AS pctl FROM sp), drl AS (SELECT entity, session, month, 'score' AS feature, score AS x FROM sq UNION ALL SELECT entity, session, month, 'percentile', round(pctl, 9) FROM sq), ref AS (SELECT * FROM drl WHERE month IN (SELECT DISTINCT month FROM drl ORDER BY month LIMIT 24)), cur AS (SELECT * FROM drl), ed AS (SELECT feature, list_distinct(quantile_cont(x, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS edges FROM ref WHERE x IS NOT NULL GROUP BY 1)"


@query("k05_score_drift", f"{PANEL}, {_SCORES}, {_DRIFT_TAIL}", digits=4)
def score_drift(spark, sf):
    s = G.percentiles(scored(spark, sf).where("score IS NOT NULL"), "score", ["session"], "percentile")
    s = s.withColumns({"percentile": F.round("percentile", 9), "month": F.to_date(F.date_trunc("month", "session"))})
    rows = D.long_form(s, [*KEY, "month"], ["score", "percentile"])
    return K.feature_drift(K.first_periods(rows, "month", 24), rows, ["feature"], "month", "x").withColumn("severity", K.severity(F.col("psi")))


@query(
    "k07_response_drift",
    f"{PANEL}, {_IC}, ye AS (SELECT feature, CAST(year(session) AS INTEGER) AS period, avg(rank_ic) AS m FROM ic WHERE session >= DATE '1996-01-01' GROUP BY 1, 2), re AS (SELECT feature, avg(rank_ic) AS r FROM ic WHERE session < DATE '1996-01-01' GROUP BY 1) SELECT feature, period, round(m, 4) AS rank_ic, round(r, 4) AS reference_rank_ic, coalesce(sign(round(m, 9)) * sign(round(r, 9)) < 0, FALSE) AS ic_sign_change FROM ye LEFT JOIN re USING (feature)",
    digits=4,
)
def response_drift(spark, sf):
    ic = ics(spark, sf)
    cut = F.to_date(F.lit("1996-01-01"))
    now = ic.where(F.col("session") >= cut).groupBy("feature", F.year("session").alias("period")).agg(F.avg("rank_ic").alias("rank_ic"))
    return K.response_drift(now, ic.where(F.col("session") < cut).groupBy("feature").agg(F.avg("rank_ic").alias("reference_rank_ic")))


@query("k08_severity_counts", f"SELECT severity, count(*) AS n FROM ({ORACLE_SQL['k01_k04_feature_drift']}) GROUP BY 1")
def severity_counts(spark, sf):
    return K.severity_counts(feature_drift(spark, sf))


#: The drift with its index as it is: months whose rounded indices are equal would be picked by chance.
_WHOLE_PSI = f"{PANEL}, {_DRIFT}, " + _DRIFT_TAIL.replace("round(psi, 4) AS psi", "psi")


@query("k08_worst_features", f"SELECT feature, round(max(psi), 4) AS max_psi, arg_min(month, row(-round(psi, 9), month)) FILTER (psi IS NOT NULL) AS month FROM ({_WHOLE_PSI}) GROUP BY 1", digits=4)
def worst_features(spark, sf):
    return K.worst_features(feature_drift(spark, sf), 5)


@query("l12_relative_metrics", f"{PANEL}, yr AS (SELECT entity, least(greatest(ret_1d, -0.5), 0.5) / 10 AS r, bench_ret / 10 AS b FROM rets WHERE ret_1d IS NOT NULL AND bench_ret IS NOT NULL), g AS (SELECT entity, count(*) AS n, exp(sum(ln(1 + r))) - 1 AS t, exp(sum(ln(1 + b))) - 1 AS u, CASE WHEN stddev_samp(r - b) > 1e-12 THEN avg(r - b) / stddev_samp(r - b) * sqrt(52) END AS ir, CASE WHEN stddev_samp(r) > 1e-12 THEN avg(r - (pow(1.02, 1 / 52.0) - 1)) / stddev_samp(r) * sqrt(52) END AS sh FROM yr GROUP BY 1) SELECT entity, n, round(t, 4) AS total_return, round(u, 4) AS benchmark_return, round(ir, 4) AS information_ratio, round(sh, 4) AS sharpe, round((1 + t) / (1 + u) - 1, 4) AS excess_return FROM g", digits=4)
def relative(spark, sf):
    r = R.with_returns(panel(spark, sf)).where("ret_1d IS NOT NULL").select("entity", (F.least(F.greatest("ret_1d", F.lit(-0.5)), F.lit(0.5)) / 10).alias("r"), (F.col("bench_ret") / 10).alias("b"))
    return D.relative_metrics(r, ["entity"], "r", "b", 52.0, 0.02)


#: Orders with a status, and the equity that their cash makes.
_ORDERS = f"{_FILLS}, od AS (SELECT f.*, CASE l_orderkey % 11 WHEN 0 THEN 'rejected' WHEN 1 THEN 'failed' WHEN 2 THEN 'terminal_writeoff' ELSE 'filled' END AS status, value * 0.001 AS cost FROM fills f), fl AS (SELECT portfolio, date, sum(CASE WHEN side = 'sell' THEN value * 1.01 ELSE -value END) AS flow FROM od WHERE status = 'filled' GROUP BY 1, 2), cu AS (SELECT *, 1e9 + sum(flow) OVER (PARTITION BY portfolio ORDER BY date ROWS UNBOUNDED PRECEDING) AS equity FROM fl), cv AS (SELECT *, coalesce(lag(equity) OVER w, 1e9) AS before, equity / coalesce(lag(equity) OVER w, 1e9) - 1 AS daily_return, abs(equity - lag(equity) OVER w) AS jump, equity / max(equity) OVER (PARTITION BY portfolio ORDER BY date ROWS UNBOUNDED PRECEDING) - 1 AS dd FROM cu WINDOW w AS (PARTITION BY portfolio ORDER BY date))"


def orders(spark, sf):
    k = F.col("l_orderkey") % 11
    status = F.when(k == 0, "rejected").when(k == 1, "failed").when(k == 2, "terminal_writeoff").otherwise("filled")
    return fills(spark, sf).withColumns({"status": status, "cost": F.col("value") * 0.001})


def curve(spark, sf):
    done = orders(spark, sf).where("status = 'filled'").withColumn("cash", F.when(F.col("side") == "sell", F.col("value") * 1.01).otherwise(-F.col("value")))
    return M.equity_curve(done, "portfolio", "date", "cash", 1e9)


@query("l09_portfolio_metrics", f"WITH {_ORDERS}, la AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY portfolio ORDER BY date DESC) AS n, min(dd) OVER (PARTITION BY portfolio) AS mdd FROM cv) WHERE n = 1), tr AS (SELECT portfolio, date, sum(value) FILTER (status = 'filled') AS traded, sum(cost) FILTER (status = 'filled') AS cost, avg(CAST(status = 'rejected' AS INTEGER)) AS rejected FROM od GROUP BY 1, 2) SELECT la.portfolio, la.date, round(equity / 1e9, 6) AS nav, round(daily_return, 6) AS daily_return, round(dd, 6) AS drawdown, round(mdd, 6) AS max_drawdown, round(coalesce(traded / before, 0), 6) AS turnover, round(coalesce(cost / before, 0), 6) AS cost_ratio, round(coalesce(rejected, 0), 6) AS rejected_ratio FROM la LEFT JOIN tr ON tr.portfolio = la.portfolio AND tr.date = la.date")
def portfolio_metrics(spark, sf):
    return M.portfolio_metrics(curve(spark, sf), orders(spark, sf), "portfolio", "date", 1e9)


@query("l14_l17_accounting", f"WITH {_ORDERS}, t AS (SELECT portfolio, " + ", ".join(f"count(*) FILTER (status = '{s}' AND side = '{d}') AS {s}_{d}s" for s in ("filled", "rejected") for d in ("buy", "sell")) + ", count(*) FILTER (status = 'terminal_writeoff') AS write_offs, coalesce(sum(cost) FILTER (status = 'filled'), 0) AS total_cost FROM od GROUP BY 1), x AS (SELECT portfolio, max(daily_return) AS best_day, min(daily_return) AS worst_day, coalesce(max(jump), 0) AS largest_jump FROM cv GROUP BY 1) SELECT portfolio, filled_buys, filled_sells, rejected_buys, rejected_sells, write_offs, round(total_cost, 2) AS total_cost, round(best_day, 6) AS best_day, round(worst_day, 6) AS worst_day, round(largest_jump, 2) AS largest_jump FROM t JOIN x USING (portfolio)")
def accounting(spark, sf):
    out = M.accounting_summary(curve(spark, sf), orders(spark, sf), "portfolio", "date")
    return out.withColumns({c: F.round(F.col(c) + 1e-9, 2) for c in ("total_cost", "largest_jump")})


@query("l16_ledger_rules", f"WITH {_ORDERS}, bo AS (SELECT equity / 4 - CASE WHEN portfolio % 5 = 0 THEN equity ELSE 0 END AS cash, equity * 3 / 4 AS holdings, equity + CASE WHEN portfolio % 3 = 0 THEN 1 ELSE 0 END - CASE WHEN portfolio % 5 = 0 THEN equity ELSE 0 END AS equity FROM cu), p AS (SELECT *, sum(CASE WHEN side = 'buy' THEN shares ELSE -shares END) OVER (PARTITION BY portfolio, entity ORDER BY date, l_orderkey, l_linenumber, value, shares ROWS UNBOUNDED PRECEDING) AS held, row_number() OVER (PARTITION BY portfolio, entity ORDER BY date, l_orderkey, l_linenumber, value, shares) AS n FROM od) SELECT 'not_finite' AS rule, CAST(0 AS BIGINT) AS violations UNION ALL SELECT 'negative', count(*) FILTER (least(cash, holdings, equity) < -1e-6) FROM bo UNION ALL SELECT 'not_reconciled', count(*) FILTER (abs(equity - cash - holdings) > 1e-6 + 1e-10 * abs(cash + holdings)) FROM bo UNION ALL SELECT 'sold_first', count(*) FILTER (n = 1 AND side = 'sell') FROM p UNION ALL SELECT 'oversold', count(*) FILTER (side = 'sell' AND held < -1e-9) FROM p UNION ALL SELECT 'negative_order', CAST(0 AS BIGINT)")
def ledger_rules(spark, sf):
    off = F.when(F.col("portfolio") % 5 == 0, F.col("equity")).otherwise(0.0)
    book = curve(spark, sf).select((F.col("equity") / 4 - off).alias("cash"), (F.col("equity") * 3 / 4).alias("holdings"), (F.col("equity") + F.when(F.col("portfolio") % 3 == 0, 1.0).otherwise(0.0) - off).alias("equity"))
    lives = M.lifecycle_violations(orders(spark, sf), ["portfolio", "entity"], ["date", "l_orderkey", "l_linenumber", "value", "shares"])
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(c).alias("violations")) for n, c in (("sold_first", "sold_first"), ("oversold", "oversold"), ("negative_order", "negative"))]))
    return Q.rule_table(book, M.ledger_rules(), "book").drop("table").unionByName(lives.select(each.alias("r")).select("r.*"))


@query("l04_l07_by_model", f"{PANEL}, {_FRAME}, sc AS (SELECT 'returns' AS model_id, entity, session, round(f_ret, 9) AS score, y FROM frame UNION ALL SELECT 'volume', entity, session, round(f_vol, 9), y FROM frame), rk AS (SELECT *, row_number() OVER (PARTITION BY model_id, session ORDER BY score DESC NULLS LAST, entity) AS rank, count(*) OVER (PARTITION BY model_id, session) AS n FROM sc), d AS (SELECT model_id, CAST(greatest(1, least(10, ceil((1 - (rank - 1) / n) * 10))) AS INTEGER) AS decile, avg(y) AS m FROM rk WHERE y IS NOT NULL GROUP BY 1, 2), o AS (SELECT *, rank() OVER (PARTITION BY model_id ORDER BY decile) AS a, rank() OVER (PARTITION BY model_id ORDER BY m) AS b FROM d), mo AS (SELECT model_id, (avg(a * b) - avg(a) * avg(b)) / (stddev_pop(a) * stddev_pop(b)) AS mono FROM o GROUP BY 1) SELECT model_id, round(avg(CAST(y > 0 AS INTEGER)), 4) AS hit_rate, " + ", ".join(f"round(avg(CASE WHEN rank <= {k} THEN y END), 4) AS top{k}_ret, round(avg(CASE WHEN rank <= {k} AND y IS NOT NULL THEN CAST(y > 0 AS INTEGER) END), 4) AS top{k}_hit" for k in (10, 20, 50)) + ", round(any_value(mono), 4) AS monotonicity FROM rk JOIN mo USING (model_id) GROUP BY 1", digits=4)
def by_model(spark, sf):
    from .metrics import frame

    f = frame(spark, sf)
    s = f.select(F.lit("returns").alias("model_id"), *KEY, F.round("f_ret", 9).alias("score"), "y").unionByName(f.select(F.lit("volume").alias("model_id"), *KEY, F.round("f_vol", 9).alias("score"), "y"))
    r = G.ranked(s, "score", ["model_id", "session"])
    mono = M.monotonicity(M.decile_returns(r, ["model_id"]), ["model_id"])
    return M.daily_performance(r, ["model_id"]).drop("rank_ic").join(mono, "model_id")


@query("j06_eras_and_samples", f"{PANEL}, v AS (SELECT *, CASE WHEN session < DATE '1998-01-01' THEN 'early' ELSE 'late' END AS era, CAST(entity AS VARCHAR) || '|' || CAST(session AS VARCHAR) AS key FROM panel WHERE traded), b AS (SELECT era, 'close_at_low' AS rule, key FROM v WHERE close = low AND high > low UNION ALL SELECT era, 'open_at_high', key FROM v WHERE open = high AND high > low) SELECT era, rule, max(n) AS violations, string_agg(key, ',' ORDER BY key) AS samples FROM (SELECT *, row_number() OVER (PARTITION BY era, rule ORDER BY key) AS r, count(*) OVER (PARTITION BY era, rule) AS n FROM b) WHERE r <= 3 GROUP BY 1, 2")
def eras(spark, sf):
    p = panel(spark, sf).where("traded").withColumn("era", F.when(F.col("session") < F.to_date(F.lit("1998-01-01")), "early").otherwise("late"))
    c = F.col
    return Q.violation_samples(p, {"close_at_low": (c("close") == c("low")) & (c("high") > c("low")), "open_at_high": (c("open") == c("high")) & (c("high") > c("low"))}, KEY, "era")


@query("j11_mismatch_samples", "WITH a AS (SELECT o_orderkey AS k, o_totalprice AS p FROM orders), b AS (SELECT l_orderkey AS k, sum(l_extendedprice) AS p FROM lineitem GROUP BY 1), f AS (SELECT CAST(coalesce(a.k, b.k) AS VARCHAR) AS key, CASE WHEN b.k IS NULL THEN 'only_left' WHEN a.k IS NULL THEN 'only_right' WHEN abs(a.p - b.p) > 50000 THEN 'p_differs' END AS rule FROM a FULL JOIN b ON a.k = b.k), n AS (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY key) AS r, count(*) OVER (PARTITION BY rule) AS n FROM f WHERE rule IS NOT NULL) SELECT rule, max(n) AS violations, string_agg(key, ',' ORDER BY key) AS samples FROM n WHERE r <= 5 GROUP BY 1")
def mismatches(spark, sf):
    a = read(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("a"), F.lit(1).alias("in_a"))
    b = read(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.sum("l_extendedprice").alias("b")).withColumn("in_b", F.lit(1))
    both = a.join(b, "k", "full")
    rules = {"only_left": F.col("in_b").isNull(), "only_right": F.col("in_a").isNull(), "p_differs": F.abs(F.col("a") - F.col("b")) > 50000}
    return Q.violation_samples(both, rules, ["k"], n=5)


@query("j15_readiness", f"{PANEL}, q AS (SELECT session, traded, CAST(ret_1d IS NULL AS INTEGER) + CAST(bench_ret IS NULL AS INTEGER) AS l FROM rets), o AS (SELECT session, count(*) AS eligible, avg(l) / 2 AS missing_ratio, count(*) FILTER (l = 0) AS surviving FROM q WHERE traded GROUP BY 1), w AS (SELECT *, quantile_cont(surviving, 0.5) OVER v AS baseline, count(surviving) OVER v AS h FROM o WINDOW v AS (ORDER BY session ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)) SELECT session, eligible, round(missing_ratio, 6) AS missing_ratio, surviving, round(baseline, 6) AS baseline, round(CASE WHEN baseline > 0 THEN surviving / baseline END, 6) AS ratio, CASE WHEN surviving < 1 THEN 'severe' WHEN h < 5 THEN 'short_history' WHEN CASE WHEN baseline > 0 THEN surviving / baseline END < 0.5 THEN 'severe' WHEN CASE WHEN baseline > 0 THEN surviving / baseline END < 0.8 THEN 'moderate' ELSE 'ok' END AS band FROM w")
def readiness(spark, sf):
    return Q.readiness(R.with_returns(panel(spark, sf)), F.col("traded"), ["ret_1d", "bench_ret"], 10, 5)


@query("j16_signal_checks", f"{PANEL}, s AS (SELECT entity, CASE WHEN entity % 4 = 1 AND pos % 9 = 0 THEN session + 1 ELSE session END AS session, CASE WHEN pos % 13 = 0 THEN session ELSE session + 7 END AS entry_session FROM panel WHERE traded UNION ALL SELECT entity, session, session + 7 FROM panel WHERE traded AND pos % 17 = 0 AND entity % 4 <> 1) SELECT count(*) FILTER (c.session IS NULL) AS off_calendar, count(*) FILTER (entry_session <= s.session) AS not_later, (SELECT CAST(coalesce(sum(k - 1), 0) AS BIGINT) FROM (SELECT count(*) AS k FROM s GROUP BY entity, session)) AS duplicates FROM s LEFT JOIN cal c ON c.session = s.session")
def signal_checks(spark, sf):
    p = panel(spark, sf).where("traded")
    week = lambda c: F.date_add(c, 7)
    s = p.select("entity", F.when((F.col("entity") % 4 == 1) & (F.col("pos") % 9 == 0), F.date_add("session", 1)).otherwise(F.col("session")).alias("session"), F.when(F.col("pos") % 13 == 0, F.col("session")).otherwise(week("session")).alias("entry_session"))
    again = p.where("pos % 17 = 0 AND entity % 4 <> 1").select("entity", "session", week("session").alias("entry_session"))
    return Q.signal_checks(s.unionByName(again), calendar(spark, sf))


@query("b04_weeks", "SELECT CAST(date_trunc('week', d) AS DATE) AS period, max(d) AS session FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem) GROUP BY 1")
def weeks(spark, sf):
    days = C.open_sessions(read(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("session")))
    return C.period_ends(days, "week")


@query("b08_report_periods", "WITH q AS (SELECT CAST(last_day(CAST(d AS DATE) + INTERVAL 2 MONTH) AS DATE) AS period FROM (SELECT unnest(generate_series(DATE '1990-01-01', DATE '2000-10-01', INTERVAL 3 MONTH)) AS d)) SELECT period, (SELECT count(*) FROM orders WHERE CAST(o_orderdate AS DATE) > period AND CAST(o_orderdate AS DATE) <= period + 100) AS n FROM q WHERE period <= DATE '1997-03-15' AND period >= DATE '1996-01-01' - 400")
def report_periods(spark, sf):
    periods = C.report_periods(spark, "1996-01-01", "1997-03-15", 400)
    days = read(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("k"))
    within = periods.select("period", F.explode(F.sequence(F.date_add("period", 1), F.date_add("period", 100))).alias("day"))
    return periods.join(within.join(days, "day").groupBy("period").agg(F.sum("k").alias("n")), "period", "left").select("period", F.coalesce("n", F.lit(0)).alias("n"))


_PORTFOLIO = "pf AS (SELECT session, CAST(year(session) AS INTEGER) AS year, avg(CASE WHEN ret_1d IS NOT NULL THEN least(greatest(ret_1d, -0.5), 0.5) END) / 10 AS ret, avg(CASE WHEN bench_ret IS NOT NULL THEN least(greatest(bench_ret, -0.5), 0.5) END) / 10 AS bench_ret, avg(CAST(traded AS INTEGER)) AS turnover FROM rets GROUP BY 1, 2), pr AS (SELECT * FROM pf WHERE ret IS NOT NULL)"


@query(
    "l13_yearly_regimes",
    f"{PANEL}, {_PORTFOLIO}, cu AS (SELECT *, sum(ln(1 + ret)) OVER w AS lg FROM pr WINDOW w AS (PARTITION BY year ORDER BY session ROWS UNBOUNDED PRECEDING)), dd AS (SELECT *, exp(lg - max(lg) OVER (PARTITION BY year ORDER BY session ROWS UNBOUNDED PRECEDING)) - 1 AS d FROM cu), "
    "y AS (SELECT year, exp(sum(ln(1 + ret))) - 1 AS c, exp(sum(ln(1 + bench_ret))) - 1 AS b, stddev_samp(ret) AS sd, avg(ret) AS m, min(d) AS d, avg(CAST(ret > 0 AS INTEGER)) AS w, avg(turnover) AS t FROM dd GROUP BY 1) "
    "SELECT year, CASE WHEN b >= 0.02 THEN 'bull' WHEN b <= -0.02 THEN 'bear' ELSE 'neutral' END AS regime, round(c, 4) AS cumulative_return, round(b, 4) AS benchmark_return, round((1 + c) / (1 + b) - 1, 4) AS excess_return, round(sd * sqrt(52), 4) AS volatility, round((m - (pow(1.02, 1 / 52.0) - 1)) / sd * sqrt(52), 4) AS sharpe, round(d, 4) AS max_drawdown, round(w, 4) AS win_rate, round(t, 4) AS turnover FROM y",
    digits=4,
)
def yearly_regimes(spark, sf):
    cut = lambda c: F.avg(F.when(F.col(c).isNotNull(), F.least(F.greatest(F.col(c), F.lit(-0.5)), F.lit(0.5)))) / 10
    daily = R.with_returns(panel(spark, sf)).groupBy("session").agg(cut("ret_1d").alias("ret"), cut("bench_ret").alias("bench_ret"), F.avg(F.col("traded").cast("double")).alias("turnover"))
    return D.yearly_metrics(daily, 52.0, 0.02, -0.02, 0.02)


@query(
    "l22_distributions",
    "WITH c AS (SELECT *, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS seg, CASE WHEN c_custkey % 11 > 0 THEN c_acctbal END AS bal FROM customer) "
    "SELECT 'seg' AS \"column\", coalesce(seg, 'Unknown') AS name, count(*) AS n FROM c GROUP BY 2 UNION ALL "
    "SELECT 'bal', b.band, count(c_custkey) FROM (VALUES ('debt', 0), ('small', 1), ('middle', 2), ('huge', 3), ('missing', 4)) AS b(band, k) LEFT JOIN c ON k = CASE WHEN bal IS NULL THEN 4 WHEN bal < 0 THEN 0 WHEN bal < 2000 THEN 1 WHEN bal < 100000 THEN 2 ELSE 3 END GROUP BY 2",
)
def distributions(spark, sf):
    k = F.col("c_custkey")
    c = read(spark, sf, "customer").select(F.when(k % 7 != 0, F.col("c_mktsegment")).alias("seg"), F.when(k % 11 > 0, F.col("c_acctbal")).alias("bal"))
    return M.distributions(c, ["seg"], {"bal": [("debt", 0), ("small", 2000), ("middle", 100000), ("huge", float("inf"))]})


@query("j14_missing_entities", "SELECT s_suppkey AS entity FROM supplier WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE CAST(l_shipdate AS DATE) = DATE '1997-03-03')")
def missing_entities(spark, sf):
    rows = read(spark, sf, "lineitem").select(F.col("l_suppkey").alias("entity"), "l_shipdate")
    return Q.missing_entities(rows, read(spark, sf, "supplier").select(F.col("s_suppkey").alias("entity")), "l_shipdate", "1997-03-03")


_RUN = "(SELECT 'rank_ic' AS metric, avg(c) AS value FROM (SELECT session, CASE WHEN stddev_pop(a) * stddev_pop(b) > 1e-14 THEN (avg(a * b) - avg(a) * avg(b)) / (stddev_pop(a) * stddev_pop(b)) END AS c FROM (SELECT session, rank() OVER (PARTITION BY session ORDER BY x) + (count(*) OVER (PARTITION BY session, x) - 1) / 2.0 AS a, rank() OVER (PARTITION BY session ORDER BY y) + (count(*) OVER (PARTITION BY session, y) - 1) / 2.0 AS b FROM {0} WHERE y IS NOT NULL) GROUP BY session HAVING count(*) >= 5) UNION ALL SELECT 'top_3_mean', avg(y) FROM (SELECT * FROM {0} QUALIFY row_number() OVER (PARTITION BY session ORDER BY x DESC, entity) <= 3))"


@query(
    "i24_metric_deltas",
    f"{PANEL}, {_FRAME}, ra AS (SELECT entity, session, round(f_ret, 9) AS x, round(y, 12) AS y FROM frame WHERE f_ret IS NOT NULL), rb AS (SELECT entity, session, round(f_ret + f_vol / 100, 9) AS x, round(y, 12) AS y FROM frame WHERE f_ret IS NOT NULL), "
    f"ma AS {_RUN.format('ra')}, mb AS {_RUN.format('rb')} SELECT metric, round(ma.value, 4) AS a, round(mb.value, 4) AS b, round(abs(ma.value - mb.value), 4) AS delta, abs(ma.value - mb.value) <= CASE metric WHEN 'rank_ic' THEN 0.001 ELSE 100 END AS passed FROM ma JOIN mb USING (metric)",
    digits=4,
)
def metric_deltas(spark, sf):
    f = frame(spark, sf).where("f_ret IS NOT NULL")

    def run(score):
        rows = f.select(*KEY, F.round(score, 9).alias("x"), "y")
        ic = D.daily_ic(rows, ["session"]).agg(F.avg("rank_ic").alias("value")).select(F.lit("rank_ic").alias("metric"), "value")
        top = Window.partitionBy("session").orderBy(F.desc("x"), "entity")
        best = rows.withColumn("_n", F.row_number().over(top)).where("_n <= 3").agg(F.avg("y").alias("value"))
        return ic.unionByName(best.select(F.lit("top_3_mean").alias("metric"), "value"))

    return D.metric_deltas(run(F.col("f_ret")), run(F.col("f_ret") + F.col("f_vol") / 100), {"rank_ic": 0.001, "top_3_mean": 100.0})
