"""Queries over calendars, rolling features and ranks (B, C, D1, F, G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import calendar as C
from ..operators import joins as J
from ..operators import labels as L
from ..operators import panel as P
from ..operators import ranks as G
from ..operators import rolling as R
from .base import PANEL, bars, calendar, gate, panel, parts, pct, query, read, sql_rounded, win

KEY = ["entity", "session"]
W = (4, 13)


@query("g_cs_rank_ret", sql_rounded(f"SELECT entity, session, exp(s) - 1 AS ret_4, amount FROM (SELECT *, {gate('sum', 'ln(1 + ret_1d)', 4)} AS s FROM rets)", "entity, session", {"ret_4": "ret_4", "cs_rank_ret_4": "cs_rank_ret_4"}, source=f"(SELECT *, {pct('e', 'session')} AS cs_rank_ret_4 FROM (SELECT *, CASE WHEN amount > 50000 THEN ret_4 END AS e FROM x))"))
def cs_rank_ret(spark, sf):
    out = R.compounded(R.with_returns(panel(spark, sf)), (4,))
    out = G.percentiles(out, "ret_4", ["session"], "cs_rank_ret_4", F.col("amount") > 50000)
    return out.select(*KEY, "ret_4", "cs_rank_ret_4")


@query("b01_open_sessions", f"{PANEL} SELECT session, pos FROM cal")
def open_sessions(spark, sf):
    return calendar(spark, sf)


@query("b02_horizon_map", f"{PANEL} SELECT c.session, c.pos, h.horizon, a.session AS entry_session, b.session AS exit_session FROM cal c CROSS JOIN (SELECT unnest([1, 5, 20]) AS horizon) h LEFT JOIN cal a ON a.pos = c.pos + 1 LEFT JOIN cal b ON b.pos = c.pos + 1 + h.horizon")
def horizon_map(spark, sf):
    return C.horizon_map(calendar(spark, sf), (1, 5, 20))


@query("b03_session_age", f"{PANEL}, f AS (SELECT min(session) AS f FROM cal), starts0 AS (SELECT entity, CAST(DATE '1991-06-01' + CAST(entity % 400 AS INTEGER) * 5 AS DATE) AS list_date FROM ents), starts AS (SELECT *, (SELECT min(pos) FROM cal WHERE session >= list_date) AS start_pos FROM starts0) SELECT p.entity, p.session, list_date, CASE WHEN p.session < list_date THEN 0 ELSE greatest(p.pos - start_pos + 1, 0) + CASE WHEN f > list_date THEN (f - list_date) * 5 // 7 ELSE 0 END END AS age FROM panel p JOIN starts USING (entity) CROSS JOIN f")
def session_age(spark, sf):
    rows = panel(spark, sf).select(*KEY).withColumn("list_date", F.date_add(F.lit("1991-06-01").cast("date"), (F.col("entity") % 400 * 5).cast("int")))
    return C.session_age(rows, calendar(spark, sf), "list_date").withColumn("age", F.col("age").cast("long"))


@query("b04_period_ends", f"{PANEL} SELECT CAST(date_trunc('month', session) AS DATE) AS period, max(session) AS session FROM cal GROUP BY 1")
def period_ends(spark, sf):
    return C.period_ends(calendar(spark, sf), "month")


@query("b05_b06_mature_sessions", f"{PANEL}, t AS (SELECT max(pos) AS top FROM cal) SELECT session, 'mature' AS kind FROM cal, t WHERE pos = top - 6 UNION ALL SELECT session, 'executable' FROM cal, t WHERE pos + 5 + 3 + 1 <= top")
def mature_sessions(spark, sf):
    cal = calendar(spark, sf)
    return C.last_mature(cal, 5).withColumn("kind", F.lit("mature")).unionByName(C.executable_sessions(cal, 5, 3).select("session", F.lit("executable").alias("kind")))


@query("b07_previous_sessions", f"{PANEL} SELECT c.session, p.session AS previous, c.pos - p.pos AS back FROM cal c JOIN cal p ON p.pos BETWEEN c.pos - 5 AND c.pos - 1")
def previous_sessions(spark, sf):
    return C.previous_sessions(calendar(spark, sf), 5).withColumn("back", F.col("back").cast("long"))


@query("b08_chunks", f"{PANEL} SELECT CAST(date_trunc('year', session) AS DATE) AS chunk, min(session) AS first, max(session) AS last, count(*) AS n FROM cal GROUP BY 1")
def chunks(spark, sf):
    return C.chunks(calendar(spark, sf), "year")


_FOLDS = "folds AS (SELECT fold, greatest(1, val_lo - 1 - 6 - 104 + 1) AS train_lo, val_lo - 1 - 6 AS train_hi, val_lo, val_hi, eval_lo, eval_hi FROM (SELECT *, eval_lo - 1 - 6 - 26 + 1 AS val_lo, eval_lo - 1 - 6 AS val_hi FROM (SELECT CAST(date_trunc('month', session) AS DATE) AS fold, min(pos) AS eval_lo, max(pos) AS eval_hi FROM cal GROUP BY 1) WHERE fold >= DATE '1994-01-01') WHERE val_lo - 7 >= greatest(1, val_lo - 7 - 103))"


@query("b09_walk_forward_folds", f"{PANEL}, {_FOLDS} SELECT * FROM folds")
def folds(spark, sf):
    out = C.walk_forward_folds(calendar(spark, sf), "1994-01-01", 104, 26, (1, 5))
    return out.select("fold", *[F.col(c).cast("long").alias(c) for c in out.columns[1:]])


@query("b10_assign_folds", f"{PANEL}, {_FOLDS} SELECT fold, role, count(*) AS n_rows, count(DISTINCT p.session) AS n_sessions FROM (SELECT fold, 'train' AS role, train_lo AS lo, train_hi AS hi FROM folds UNION ALL SELECT fold, 'validation', val_lo, val_hi FROM folds UNION ALL SELECT fold, 'evaluation', eval_lo, eval_hi FROM folds) f JOIN panel p ON p.pos BETWEEN lo AND hi WHERE traded GROUP BY fold, role")
def assigned(spark, sf):
    cal = calendar(spark, sf)
    roles = C.assign_folds(cal, C.walk_forward_folds(cal, "1994-01-01", 104, 26, (1, 5)))
    per = bars(spark, sf).groupBy("session").agg(F.count(F.lit(1)).alias("n"))
    return roles.join(per, "session").groupBy("fold", "role").agg(F.sum("n").alias("n_rows"), F.countDistinct("session").alias("n_sessions"))


@query("c01_c02_coercion", "SELECT event_id, try_cast(json_extract_string(props, '$.' || k) AS DOUBLE) AS x, CASE WHEN d ~ '^[0-9]{8}$' THEN CAST(try_strptime(d, '%Y%m%d') AS DATE) END AS d FROM (SELECT event_id, props, json_keys(props)[1] AS k, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y%m%d') WHEN 1 THEN ' ' || strftime(ts, '%Y%m%d') || '.0' WHEN 2 THEN 'nan' ELSE '0' END AS raw FROM events), LATERAL (SELECT regexp_replace(trim(raw), '\\.0$', '') AS d)")
def coercion(spark, sf):
    e = read(spark, sf, "events")
    raw = F.when(F.col("event_id") % 4 == 0, F.date_format("ts", "yyyyMMdd")).when(F.col("event_id") % 4 == 1, F.concat(F.lit(" "), F.date_format("ts", "yyyyMMdd"), F.lit(".0"))).when(F.col("event_id") % 4 == 2, F.lit("nan")).otherwise(F.lit("0"))
    k = F.get(F.expr("json_object_keys(props)"), F.lit(0))
    first = F.from_json("props", "map<string,string>")
    return e.select("event_id", P.numeric(F.element_at(first, k)).alias("x"), P.clean_date(raw).alias("d"))


@query("c03_era_rule", f"{PANEL} SELECT entity, session, ok AS is_valid, ok OR session >= DATE '1998-01-01' AS is_kept FROM (SELECT *, least(open, high, low, close) > 0 AND h2 >= greatest(open, close, low) AND low <= least(open, close, h2) AS ok FROM (SELECT *, CASE WHEN entity % 7 = 0 THEN high * 0.9 ELSE high END AS h2 FROM bars))")
def era(spark, sf):
    b = bars(spark, sf).withColumn("high", F.when(F.col("entity") % 7 == 0, F.col("high") * 0.9).otherwise(F.col("high")))
    return P.era_flags(b, "1998-01-01").select(*KEY, "is_valid", "is_kept")


@query("c04_keep_last", "SELECT o_custkey, o_orderkey, o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1")
def keep_last(spark, sf):
    return P.keep_last(read(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_orderdate")


@query("c05_adjusted_prices", sql_rounded("SELECT entity, session, close * f AS adj_close, open * f AS adj_open FROM bars LEFT JOIN (SELECT entity, CAST(session + 7 AS DATE) AS session, 1 + pos / 100.0 AS f FROM panel) USING (entity, session)", "entity, session", ["adj_close", "adj_open"]))
def adjusted(spark, sf):
    f = panel(spark, sf).select("entity", F.date_add("session", 7).alias("session"), (1 + F.col("pos") / 100.0).alias("factor"))
    return P.adjusted(bars(spark, sf), f, KEY, ["close", "open"]).select(*KEY, "adj_close", "adj_open")


@query("c06_c07_c10_labels_units", "SELECT p_partkey, CASE WHEN p_brand ~ '[1-2]$' THEN 'low' WHEN p_brand ~ '[3-4]$' THEN 'mid' ELSE 'high' END AS board, contains(upper(replace(p_type, ' ', '')), 'STEEL') AS marked, round(p_retailprice * 100, 6) AS p_retailprice FROM part")
def labels_units(spark, sf):
    p = P.rescaled(read(spark, sf, "part"), {"p_retailprice": 100})
    return p.select("p_partkey", P.classify("p_brand", [("[1-2]$", "low"), ("[3-4]$", "mid")], "high").alias("board"), P.has_marker("p_type", "STEEL").alias("marked"), "p_retailprice")


@query("c08_c09_candidates", f"{PANEL} SELECT coalesce(k.entity, s.entity) AS entity, coalesce(list_date, first_session) AS list_date, last_session, CAST(NULL AS VARCHAR) AS delist_reason FROM (SELECT s_suppkey + 3 AS entity, CASE WHEN s_suppkey % 2 = 0 THEN DATE '1991-01-01' END AS list_date FROM supplier) k FULL JOIN (SELECT entity, min(session) AS first_session, max(session) AS last_session FROM bars GROUP BY 1) s ON k.entity = s.entity")
def candidates(spark, sf):
    k = read(spark, sf, "supplier").select((F.col("s_suppkey") + 3).alias("entity"), F.when(F.col("s_suppkey") % 2 == 0, F.lit("1991-01-01").cast("date")).alias("list_date"))
    return P.complete(P.candidates(k, bars(spark, sf)), {"entity": "long", "list_date": "date", "last_session": "date", "delist_reason": "string"})


@query("d01_densify", sql_rounded("SELECT * FROM panel", "entity, session, pos, traded", ["close", "amount"]))
def dense(spark, sf):
    return panel(spark, sf).select(*KEY, "pos", "traded", "close", "amount")


def _ret(spark, sf):
    return R.with_returns(panel(spark, sf))


@query("f01_f05_returns", sql_rounded("SELECT * FROM rets", "entity, session", ["ret_1d", "bench_ret"]))
def returns(spark, sf):
    return _ret(spark, sf).select(*KEY, "ret_1d", "bench_ret")


@query("f02_candle", sql_rounded("SELECT * FROM panel", "entity, session", {"intraday_ret": "close / open - 1", "candle_body": "abs(close - open) / nullif(high - low, 0)", "upper_shadow": "(high - greatest(open, close)) / nullif(high - low, 0)", "lower_shadow": "(least(open, close) - low) / nullif(high - low, 0)", "close_location": "(close - low) / nullif(high - low, 0)"}))
def candle(spark, sf):
    return R.candle(panel(spark, sf)).select(*KEY, "intraday_ret", "candle_body", "upper_shadow", "lower_shadow", "close_location")


@query("f03_gaps", sql_rounded("SELECT *, open / lag(close) OVER (PARTITION BY entity ORDER BY pos) - 1 AS g FROM panel", "entity, session", {"gap_open_ret": "g", "gap_abs": "abs(g)"} | {f"gap_mean_{w}": f"avg(g) OVER {win(w)}" for w in W}))
def gaps(spark, sf):
    return R.gaps(panel(spark, sf), W).select(*KEY, "gap_open_ret", "gap_abs", *[f"gap_mean_{w}" for w in W])


@query("f04_f06_f21_compounded", sql_rounded("SELECT entity, session, " + ", ".join(f"{gate('sum', 'ln(1 + ret_1d)', w)} AS s{w}, {gate('sum', 'ln(1 + bench_ret)', w)} AS b{w}" for w in W) + " FROM rets", "entity, session", {k: v for w in W for k, v in {f"logret_sum_{w}": f"s{w}", f"ret_{w}": f"exp(s{w}) - 1", f"market_excess_ret_{w}": f"exp(s{w}) - exp(b{w})", f"reversal_ret_{w}": f"1 - exp(s{w})"}.items()}))
def compounded(spark, sf):
    return R.compounded(_ret(spark, sf), W).select(*KEY, *[f"{k}_{w}" for w in W for k in ("logret_sum", "ret", "market_excess_ret", "reversal_ret")])


@query("f07_trend", sql_rounded("SELECT *, " + ", ".join(f"{gate('avg', 'close', w)} AS m{w}, {gate('stddev_samp', 'close', w)} AS s{w}, lag(close, {w}) OVER (PARTITION BY entity ORDER BY pos) AS l{w}" for w in W) + " FROM panel", "entity, session", {k: v for w in W for k, v in {f"ma_ratio_{w}": f"close / m{w}", f"ma_z_{w}": f"CASE WHEN s{w} > 1e-9 THEN (close - m{w}) / s{w} END", f"trend_slope_{w}": f"m{w} / l{w} - 1"}.items()}))
def trend(spark, sf):
    return R.trend(panel(spark, sf), W).select(*KEY, *[f"{k}_{w}" for w in W for k in ("ma_ratio", "ma_z", "trend_slope")])


@query("f08_f10_dispersion", sql_rounded("SELECT *, CASE WHEN ret_1d IS NOT NULL THEN CAST(ret_1d > 0 AS INTEGER) END AS u, CASE WHEN ret_1d IS NOT NULL THEN pow(least(ret_1d, 0), 2) END AS d FROM rets", "entity, session", {k: v for w in W for k, v in {f"positive_ret_ratio_{w}": gate("avg", "u", w), f"realized_vol_{w}": gate("stddev_samp", "ret_1d", w), f"downside_vol_{w}": f"sqrt({gate('avg', 'd', w)})"}.items()}))
def dispersion(spark, sf):
    return R.dispersion(_ret(spark, sf), W).select(*KEY, *[f"{k}_{w}" for w in W for k in ("positive_ret_ratio", "realized_vol", "downside_vol")])


@query("f11_f12_f15_activity", sql_rounded("SELECT *, 1e6 * abs(ret_1d) / amount AS i FROM rets", "entity, session", {k: v for w in W for k, v in {f"volume_ratio_{w}": f"vol / ({gate('avg', 'vol', w)})", f"amount_ratio_{w}": f"amount / ({gate('avg', 'amount', w)})", f"amount_cv_{w}": f"({gate('stddev_samp', 'amount', w)}) / ({gate('avg', 'amount', w)})", f"amihud_{w}": gate("avg", "i", w)}.items()}))
def activity(spark, sf):
    out = R.activity(_ret(spark, sf), W)
    return out.select(*KEY, *[(F.col(f"{k}_{w}") * (1e6 if k == "amihud" else 1)).alias(f"{k}_{w}") for w in W for k in ("volume_ratio", "amount_ratio", "amount_cv", "amihud")])


@query("f13_f14_extremes", sql_rounded("SELECT *, " + ", ".join(f"{gate('min', f'd{w}', w)} AS md{w}" for w in W) + " FROM (SELECT *, " + ", ".join(f"close / t{w} - 1 AS d{w}" for w in W) + " FROM (SELECT *, " + ", ".join(f"{gate('max', 'high', w)} AS h{w}, {gate('min', 'low', w)} AS o{w}, {gate('max', 'close', w)} AS t{w}" for w in W) + " FROM panel))", "entity, session", {k: v for w in W for k, v in {f"dist_high_{w}": f"close / h{w} - 1", f"dist_low_{w}": f"close / o{w} - 1", f"range_pos_{w}": f"(close - o{w}) / nullif(h{w} - o{w}, 0)", f"drawdown_{w}": f"d{w}", f"max_drawdown_{w}": f"md{w}"}.items()}))
def extremes(spark, sf):
    return R.extremes(panel(spark, sf), W).select(*KEY, *[f"{k}_{w}" for w in W for k in ("dist_high", "dist_low", "range_pos", "drawdown", "max_drawdown")])


def _cov(x: str, y: str, w: int) -> str:
    n = f"count({x} * {y}) OVER {win(w)}"
    return f"CASE WHEN {n} >= ceil({w} * 0.6) AND {n} > 1 THEN (avg({x} * {y}) OVER {win(w)} - avg({x}) OVER {win(w)} * avg({y}) OVER {win(w)}) * {n} / ({n} - 1) END"


@query("f16_f18_comovement", sql_rounded("SELECT *, " + ", ".join(f"{gate('stddev_samp', f'r{w}', w)} AS rv{w}" for w in W) + " FROM (SELECT *, " + ", ".join(f"ret_1d - be{w} * bench_ret AS r{w}" for w in W) + " FROM (SELECT *, " + ", ".join(f"c{w} / (CASE WHEN s{w} > 1e-12 THEN s{w} END * CASE WHEN t{w} > 1e-12 THEN t{w} END) AS co{w}, b{w} / CASE WHEN v{w} > 1e-12 THEN v{w} END AS be{w}" for w in W) + " FROM (SELECT *, " + ", ".join(f"{_cov('ret_1d', 'vc', w)} AS c{w}, {_cov('ret_1d', 'bench_ret', w)} AS b{w}, {gate('var_samp', 'bench_ret', w)} AS v{w}, {gate('stddev_samp', 'ret_1d', w)} AS s{w}, {gate('stddev_samp', 'vc', w)} AS t{w}" for w in W) + " FROM (SELECT *, vol / lag(vol) OVER (PARTITION BY entity ORDER BY pos) - 1 AS vc FROM rets))))", "entity, session", {k: v for w in W for k, v in {f"ret_vol_corr_{w}": f"co{w}", f"beta_{w}": f"be{w}", f"residual_vol_{w}": f"rv{w}"}.items()}, 4), digits=4)
def comovement(spark, sf):
    return R.comovement(_ret(spark, sf), W).select(*KEY, *[f"{k}_{w}" for w in W for k in ("ret_vol_corr", "beta", "residual_vol")])


@query("f19_valuation", "SELECT c_custkey, round(CASE WHEN c_acctbal > 0 THEN 1 / c_acctbal END, 6) AS c_acctbal_inv, round(CASE WHEN c_acctbal > 0 THEN ln(c_acctbal) END, 6) + 0.0 AS c_acctbal_log FROM customer")
def valuation(spark, sf):
    return R.valuation(read(spark, sf, "customer"), ["c_acctbal"], ["c_acctbal"]).select("c_custkey", "c_acctbal_inv", "c_acctbal_log")


@query("f22_f24_missing_ratios", f"{PANEL}, y AS (SELECT ret_1d, exp({gate('sum', 'ln(1 + ret_1d)', 4)}) - 1 AS ret_4, {gate('stddev_samp', 'ret_1d', 13)} AS realized_vol_13, session FROM rets), z AS (SELECT * FROM y WHERE session BETWEEN DATE '1995-01-01' AND DATE '1995-12-31') SELECT 'ret_1d' AS feature, round(avg(CAST(ret_1d IS NULL AS INTEGER)), 6) AS missing_ratio FROM z UNION ALL SELECT 'ret_4', round(avg(CAST(ret_4 IS NULL AS INTEGER)), 6) FROM z UNION ALL SELECT 'realized_vol_13', round(avg(CAST(realized_vol_13 IS NULL AS INTEGER)), 6) FROM z")
def missing(spark, sf):
    frame = R.feature_frame(panel(spark, sf, R.warm_up_start("1995-01-01")), W, "1995-01-01", "1995-12-31")
    return R.missing_ratios(frame, ["ret_1d", "ret_4", "realized_vol_13"])


#: The features of the table, in the order in which it has them.
REGISTRY = ("ret_1d", "ret_4", "ret_13", "realized_vol_13", "volume_ratio_4", "turnover_ratio_4", "cs_rank_ret_4", "cs_rank_realized_vol_13", "top_share", "top_share_change")
_TURN = gate("avg", "amount / close", 4)


@query(
    "f23_feature_frame",
    f"{PANEL}, a AS (SELECT o_custkey AS entity, CAST(o_orderdate AS DATE) AS available, max(o_totalprice) / sum(o_totalprice) AS top_share FROM orders GROUP BY 1, 2), fu AS (SELECT *, top_share - lag(top_share) OVER (PARTITION BY entity ORDER BY available) AS top_share_change FROM a), "
    f"m AS (SELECT entity, session, traded, ret_1d, exp({gate('sum', 'ln(1 + ret_1d)', 4)}) - 1 AS ret_4, exp({gate('sum', 'ln(1 + ret_1d)', 13)}) - 1 AS ret_13, {gate('stddev_samp', 'ret_1d', 13)} AS realized_vol_13, vol / ({gate('avg', 'vol', 4)}) AS volume_ratio_4, (amount / close) / ({_TURN}) AS turnover_ratio_4 FROM rets), "
    "q AS (SELECT *, CASE WHEN traded THEN ret_4 END AS e1, CASE WHEN traded THEN realized_vol_13 END AS e2 FROM m), "
    f"r AS (SELECT *, {pct('e1', 'session')} AS cs_rank_ret_4, {pct('e2', 'session')} AS cs_rank_realized_vol_13 FROM q) "
    "SELECT r.entity, r.session, " + ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in REGISTRY) + " FROM r ASOF LEFT JOIN fu ON fu.entity = r.entity AND r.session >= fu.available",
)
def frame(spark, sf):
    market = R.feature_frame(panel(spark, sf).withColumn("turnover_rate", F.col("amount") / F.col("close")), W)
    for c in ("ret_4", "realized_vol_13"):
        market = G.percentiles(market, c, ["session"], f"cs_rank_{c}", F.col("traded"))
    reports = read(spark, sf, "orders").groupBy(F.col("o_custkey").alias("entity"), F.to_date("o_orderdate").alias("available")).agg(F.sum("o_totalprice").alias("total"), F.max("o_totalprice").alias("top"))
    known = L.fundamental_ratios(reports, {"top_share": ("top", "total")}, ["top_share"])
    both = J.as_of(market, known.select("entity", "available", "top_share", "top_share_change"), "entity", "session", "available", ["top_share", "top_share_change"], [])
    return R.registered(both, REGISTRY)


_SCORE = "scored AS (SELECT *, round(-ret_1d, 9) AS score FROM rets WHERE traded)"


def scored(spark, sf):
    return _ret(spark, sf).where("traded").withColumn("score", F.round(-F.col("ret_1d"), 9))


@query("g01_g03_percentiles", f"{PANEL}, {_SCORE}, y AS (SELECT *, CASE WHEN amount > 50000 THEN score END AS e FROM scored) SELECT entity, session, round({pct('score', 'session')}, 6) AS p, round({pct('e', 'session')}, 6) AS p_elig, round({pct('score', 'session, grp')}, 6) AS p_grp FROM y")
def pcts(spark, sf):
    s = scored(spark, sf)
    s = G.percentiles(G.percentiles(s, "score", ["session"], "p"), "score", ["session"], "p_elig", F.col("amount") > 50000)
    return G.percentiles(s, "score", ["session", "grp"], "p_grp").select(*KEY, "p", "p_elig", "p_grp")


_RANKED = f"{_SCORE}, ranked AS (SELECT *, row_number() OVER (PARTITION BY session ORDER BY score DESC NULLS LAST, entity) AS rank, count(*) OVER (PARTITION BY session) AS cross_section_size FROM scored)"


@query("g04_g05_g07_g08_ranked", f"{PANEL}, {_RANKED} SELECT entity, session, rank, cross_section_size, round(1 - (rank - 1) / cross_section_size, 6) AS score_percentile FROM ranked WHERE cross_section_size >= 5 AND rank <= greatest(1, ceil(cross_section_size * 0.3))")
def ranked(spark, sf):
    top = G.top_fraction(G.large_groups(scored(spark, sf), ["session"], 5), "score", 0.3)
    return top.select(*KEY, F.col("rank").cast("long").alias("rank"), "cross_section_size", "score_percentile")


@query("g06_buckets", f"{PANEL}, {_SCORE}, y AS (SELECT *, {pct('score', 'session')} AS p FROM scored) SELECT entity, session, CAST(CASE WHEN p IS NOT NULL THEN greatest(0, least(4, floor((p - 1e-12) * 5))) END AS INTEGER) AS bucket_floor, CAST(CASE WHEN p IS NOT NULL THEN least(4, floor((p - 2.220446049250313e-16) * 5)) END AS INTEGER) AS bucket_floor_open, CAST(CASE WHEN p IS NOT NULL THEN greatest(0, least(4, ceil(p * 5) - 1)) END AS INTEGER) AS bucket_ceil, CAST(CASE WHEN p IS NOT NULL THEN greatest(1, least(5, ceil(p * 5))) END AS INTEGER) AS bucket_decile FROM y")
def buckets(spark, sf):
    s = G.percentiles(scored(spark, sf), "score", ["session"], "p").where("p IS NOT NULL OR p IS NULL")
    return G.bucketed(s, "p", 5).select(*KEY, *[F.when(F.col("p").isNotNull(), F.col(c)).alias(c) for c in ("bucket_floor", "bucket_floor_open", "bucket_ceil", "bucket_decile")])


@query("g09_g13_lists", f"{PANEL}, {_RANKED} SELECT n.session AS entry_session, r.session, entity, rank, k AS list_size FROM ranked r JOIN cal c ON c.session = r.session JOIN cal n ON n.pos = c.pos + 1, (SELECT unnest([3, 5]) AS k) WHERE rank <= k")
def lists(spark, sf):
    s, cal = scored(spark, sf), calendar(spark, sf)
    top = G.top_lists(s, "score", (3, 5)).select("session", "entity", F.col("rank").cast("long").alias("rank"), "list_size")
    entry = G.entry_lists(s, cal, "score", 5).select("entry_session", "session", "entity")
    return top.join(entry, ["session", "entity"]).select("entry_session", "session", "entity", "rank", "list_size")


@query("g10_outlook", f"{PANEL}, {_SCORE}, y AS (SELECT *, {pct('score', 'session')} AS p FROM scored) SELECT entity, session, CASE WHEN p IS NULL THEN NULL WHEN p >= 0.8 THEN 'strong' WHEN p >= 0.4 THEN 'neutral' ELSE 'weak' END AS outlook FROM y")
def outlook(spark, sf):
    s = G.percentiles(scored(spark, sf), "score", ["session"], "p")
    return s.select(*KEY, G.outlook("p", [(0.8, "strong"), (0.4, "neutral")], "weak").alias("outlook"))


@query("g11_ensemble", f"{PANEL}, {_SCORE}, m AS (SELECT 'a' AS model_id, session, entity, score FROM scored UNION ALL SELECT 'b', session, entity, round(vol, 9) FROM scored), y AS (SELECT *, {pct('score', 'model_id, session')} AS p FROM m), z AS (SELECT session, entity, round(avg(p), 9) AS score FROM y GROUP BY 1, 2 HAVING count(p) = 2) SELECT session, entity, round(score, 6) AS score, row_number() OVER (PARTITION BY session ORDER BY score DESC, entity) AS rank FROM z")
def ensemble(spark, sf):
    s = scored(spark, sf)
    long = s.select(F.lit("a").alias("model_id"), "session", "entity", "score").unionByName(s.select(F.lit("b").alias("model_id"), "session", "entity", F.round("vol", 9).alias("score")))
    both = G.ensemble(long, 2, parts(spark, sf)).withColumn("score", F.round("score", 9))
    return G.ranked(both.drop("rank", "cross_section_size", "score_percentile"), "score").select("session", "entity", "score", F.col("rank").cast("long").alias("rank"))


@query("g12_history_percentile", f"{PANEL}, {_SCORE}, y AS (SELECT entity, pos, session, score FROM scored WHERE score IS NOT NULL) SELECT entity, session, round((SELECT avg(CAST(h.score <= y.score AS INTEGER)) FROM y h WHERE h.entity = y.entity AND h.pos < y.pos), 6) AS history_pct FROM y")
def history(spark, sf):
    s = scored(spark, sf).where("score IS NOT NULL")
    return G.history_percentile(s, "entity", "pos", "score").select(*KEY, "history_pct")
