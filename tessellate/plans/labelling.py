"""Queries over joins, the universe and labels (D, E, H)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators import labels as L
from ..operators import rolling as R
from .base import PANEL, bars, calendar, panel, parts, query, read, sql_rounded
from .features import scored

KEY = ["entity", "session"]
H = (1, 5)
_BASE = "(grp < 22 AND pos > entity % 7 AND pos <= 345 + entity % 11)"


@query("d02_as_of", "WITH o AS (SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS p, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS n FROM orders), r AS (SELECT * FROM o WHERE n = 1), l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, o_custkey, l_shipdate - INTERVAL 60 DAY AS d FROM lineitem JOIN orders ON l_orderkey = o_orderkey) SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, r.o_orderkey AS seen_order, round(r.o_totalprice, 6) AS seen_price, r.p AS seen_priority FROM l ASOF LEFT JOIN r ON l.o_custkey = r.o_custkey AND l.d >= r.o_orderdate")
def as_of(spark, sf):
    o = read(spark, sf, "orders")
    left = read(spark, sf, "lineitem").join(o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "o_custkey", (F.col("l_shipdate") - F.expr("INTERVAL 60 DAY")).alias("d"))
    right = o.select("o_custkey", "o_orderdate", F.col("o_orderkey").alias("seen_order"), F.col("o_totalprice").alias("seen_price"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).alias("seen_priority"))
    out = J.as_of(left, right, "o_custkey", "d", "o_orderdate", ["seen_order", "seen_price", "seen_priority"], ["seen_order"])
    return out.drop("o_custkey", "d")


_REPORTS = "reports AS (SELECT o_custkey AS entity, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS period, CAST(o_orderdate AS DATE) AS ann, CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderdate AS DATE) + 7 END AS fin, o_orderkey AS rev, o_totalprice AS x FROM orders)"


def reports(spark, sf):
    d = F.to_date("o_orderdate")
    return read(spark, sf, "orders").select(F.col("o_custkey").alias("entity"), F.to_date(F.date_trunc("quarter", "o_orderdate")).alias("period"), d.alias("ann"), F.when(F.col("o_orderkey") % 4 == 0, F.date_add(d, 7)).alias("fin"), F.col("o_orderkey").alias("rev"), F.col("o_totalprice").alias("x"))


@query("d03_f20_available", f"WITH {_REPORTS}, a AS (SELECT *, coalesce(fin, ann) AS available, row_number() OVER (PARTITION BY entity, coalesce(fin, ann) ORDER BY period DESC, rev DESC) AS n FROM reports) SELECT entity, period, available, rev, round(x - lag(x) OVER (PARTITION BY entity ORDER BY available), 4) AS change FROM a WHERE n = 1", digits=4)
def available(spark, sf):
    a = J.available(reports(spark, sf), "entity", "ann", "fin", ["period", "rev"])
    change = F.col("x") - F.lag("x").over(Window.partitionBy("entity").orderBy("available"))
    return a.select("entity", "period", "available", "rev", change.alias("change"))


@query("d04_later_ratio", f"WITH {_REPORTS}, a AS (SELECT entity, period, max(ann) AS available, max(x) AS x FROM reports WHERE rev % 2 = 0 GROUP BY 1, 2), b AS (SELECT entity, period, max(ann) AS available, max(x) AS y FROM reports WHERE rev % 2 = 1 GROUP BY 1, 2) SELECT entity, period, greatest(a.available, b.available) AS available, round(x / y, 6) AS ratio FROM a JOIN b USING (entity, period)")
def later_ratio(spark, sf):
    r = reports(spark, sf)
    side = lambda k, n: r.where(F.col("rev") % 2 == k).groupBy("entity", "period").agg(F.max("ann").alias("available"), F.max("x").alias(n))
    return J.later_ratio(side(0, "x"), side(1, "y"), ["entity", "period"], "x", "y", "ratio")


_SPANS = "spans AS (SELECT o_custkey AS k, CAST(o_orderdate AS DATE) AS s, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE CAST(m AS DATE) END AS e FROM orders JOIN (SELECT l_orderkey, max(l_shipdate) AS m FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)"


def spans(spark, sf):
    last = read(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("m"))
    o = read(spark, sf, "orders").join(last, F.col("o_orderkey") == F.col("l_orderkey"))
    return o.select(F.col("o_custkey").alias("k"), F.to_date("o_orderdate").alias("s"), F.when(F.col("o_orderkey") % 50 != 0, F.to_date("m")).alias("e"))


@query("d05_interval_keys", f"{PANEL}, {_SPANS} SELECT DISTINCT k, session FROM spans JOIN cal ON session >= s AND session <= coalesce(e, DATE '9999-01-01')")
def interval_keys(spark, sf):
    return J.interval_keys(spans(spark, sf), calendar(spark, sf), "k", "s", "e")


@query("d06_d12_d14_flags", f"{PANEL}, {_SPANS}, keys AS (SELECT DISTINCT k AS entity, session FROM spans JOIN cal ON session >= s AND session <= coalesce(e, DATE '9999-01-01')) SELECT b.entity, b.session, k.entity IS NOT NULL AS flagged FROM bars b LEFT JOIN keys k ON k.entity = b.entity AND k.session = b.session WHERE EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = b.entity AND s_nationkey < 20) AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = b.entity AND s_acctbal < 0)")
def flags(spark, sf):
    s = read(spark, sf, "supplier").select(F.col("s_suppkey").alias("entity"), "s_nationkey", "s_acctbal")
    keys = J.interval_keys(spans(spark, sf), calendar(spark, sf), "k", "s", "e").withColumnRenamed("k", "entity")
    b = bars(spark, sf).join(s.where("s_nationkey < 20"), "entity", "left_semi").join(s.where("s_acctbal < 0"), "entity", "left_anti")
    return J.flag(b, keys, KEY, "flagged").select(*KEY, "flagged")


@query("d10_l15_costs_in_force", "WITH s AS (SELECT * FROM (VALUES (DATE '1990-01-01', 0.0010, 0.002), (DATE '1995-06-01', 0.0005, 0.001), (DATE '1998-01-01', 0.0002, 0.0005)) AS t(d, stamp, fee)), l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_returnflag, CAST(l_shipdate AS DATE) AS d FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice, 4) AS l_extendedprice, round(greatest(5.0, l_extendedprice * 0.0003), 4) AS commission, round(CASE WHEN l_returnflag = 'R' THEN l_extendedprice * stamp ELSE 0 END, 4) AS stamp_duty, round(l_extendedprice * fee, 4) AS transfer_fee, round(l_extendedprice * 0.001, 4) AS slippage FROM l ASOF JOIN s ON l.d >= s.d", digits=4)
def costs(spark, sf):
    from ..operators.monitor import trade_costs

    rows = read(spark, sf, "lineitem").withColumn("d", F.to_date("l_shipdate"))
    schedule = spark.createDataFrame([("1990-01-01", 0.0010, 0.002), ("1995-06-01", 0.0005, 0.001), ("1998-01-01", 0.0002, 0.0005)], "f string, stamp double, fee double").withColumn("f", F.to_date("f"))
    found = J.in_force(rows, schedule, "d", "f", ["stamp", "fee"])
    out = trade_costs(found, "l_extendedprice", F.col("l_returnflag") == "R")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "commission", "stamp_duty", "transfer_fee", "slippage")


@query("d11_j16_key_difference", "SELECT count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS n_both, count(*) FILTER (b IS NULL) AS n_left, count(*) FILTER (a IS NULL) AS n_right FROM (SELECT DISTINCT o_orderkey AS a, date_trunc('month', o_orderdate) AS ma FROM orders) FULL JOIN (SELECT DISTINCT l_orderkey AS b, date_trunc('month', l_shipdate) AS mb FROM lineitem) ON a = b AND ma = mb")
def key_difference(spark, sf):
    keys = lambda table, k, d: read(spark, sf, table).select(F.col(k).alias("k"), F.trunc(d, "month").alias("month"))
    return J.key_difference(keys("orders", "o_orderkey", "o_orderdate"), keys("lineitem", "l_orderkey", "l_shipdate"), ["k", "month"])


@query("d13_append_only", "SELECT c.event_id, CASE WHEN h.event_id IS NULL THEN 'append' WHEN h.value = c.v AND h.event_type = c.event_type THEN 'same' ELSE 'conflict' END AS outcome FROM (SELECT *, CASE WHEN event_id % 11 = 0 THEN value + 1 ELSE value END AS v FROM events) c LEFT JOIN (SELECT * FROM events WHERE ts < (SELECT max(ts) - INTERVAL 7 DAY FROM events)) h ON h.event_id = c.event_id")
def append_only(spark, sf):
    e = read(spark, sf, "events")
    now = e.withColumn("value", F.when(F.col("event_id") % 11 == 0, F.col("value") + 1).otherwise(F.col("value")))
    last = F.broadcast(e.agg((F.max("ts") - F.expr("INTERVAL 7 DAYS")).alias("until")))
    return J.append_only(now, e.join(last, e["ts"] < last["until"]), ["event_id"], ["value", "event_type"]).select("event_id", "outcome")


def limited(spark, sf):
    return L.with_limits(panel(spark, sf))


_LIMITS = "lim AS (SELECT *, last_value(close IGNORE NULLS) OVER pre * 1.5 AS up_limit, last_value(close IGNORE NULLS) OVER pre * 0.5 AS down_limit FROM panel WINDOW pre AS (PARTITION BY entity ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), trad AS (SELECT *, coalesce(traded AND close >= CASE WHEN abs(up_limit - 99999.99) > 1e-6 THEN up_limit END - 1e-6, FALSE) AS is_limit_up, coalesce(traded AND close <= CASE WHEN abs(down_limit) > 1e-6 THEN down_limit END + 1e-6, FALSE) AS is_limit_down FROM lim)"


@query("e05_d09_tradability", f"{PANEL}, {_LIMITS} SELECT entity, session, is_limit_up, is_limit_down, traded AND NOT is_limit_up AS can_buy, traded AND NOT is_limit_down AS can_sell, round(open, 6) AS open FROM trad")
def tradability(spark, sf):
    return L.tradability(limited(spark, sf)).select(*KEY, "is_limit_up", "is_limit_down", "can_buy", "can_sell", "open")


_UNIVERSE = f"{_SPANS}, liq AS (SELECT *, avg(amount) OVER w AS amount_mean, count(amount) OVER w AS amount_count FROM bars WINDOW w AS (PARTITION BY entity ORDER BY session ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)), uni AS (SELECT p.entity, p.session, p.pos, p.traded, l.amount_mean, l.amount_count, p.pos < 30 + p.entity % 10 AS is_new, k.k IS NOT NULL AS is_restricted FROM panel p LEFT JOIN liq l ON l.entity = p.entity AND l.session = p.session LEFT JOIN (SELECT DISTINCT k, session FROM spans JOIN cal ON session >= s AND session <= coalesce(e, DATE '9999-01-01')) k ON k.k = p.entity AND k.session = p.session)"


def screened(spark, sf):
    """The panel with its liquidity and `restricted`; neither takes it out of its buckets."""
    held = J.merged_intervals(spans(spark, sf), calendar(spark, sf), "k", "s", "e").withColumnRenamed("k", "entity")
    return J.flag_within(L.with_liquidity(panel(spark, sf)), held, "entity", "restricted")


def universe(spark, sf):
    return L.model_universe(screened(spark, sf).withColumn("age", F.col("pos") - F.col("entity") % 10), 30, 60000.0)


@query("e01_e07_universe", f"{PANEL}, {_UNIVERSE}, r AS (SELECT *, concat_ws(';', CASE WHEN is_new THEN 'new' END, CASE WHEN is_restricted THEN 'restricted' END, CASE WHEN NOT traded THEN 'no_price' END, CASE WHEN coalesce(amount_mean < 60000, TRUE) THEN 'low_liquidity' END) AS exclude_reason FROM uni) SELECT entity, session, round(amount_mean, 4) AS amount_mean, amount_count, exclude_reason, exclude_reason = '' AS in_model_universe FROM r", digits=4)
def built_universe(spark, sf):
    return universe(spark, sf).select(*KEY, "amount_mean", "amount_count", "exclude_reason", "in_model_universe")


_LISTED = (
    f"{_UNIVERSE}, lf AS (SELECT min(session) AS f FROM cal), ls AS (SELECT s_suppkey AS entity, CASE WHEN s_suppkey % 17 <> 0 THEN CAST(DATE '1994-06-01' + CAST(s_suppkey % 400 AS INTEGER) * 5 AS DATE) END AS list_date, CASE WHEN s_suppkey % 5 = 0 THEN CAST(DATE '1999-06-01' + CAST(s_suppkey % 200 AS INTEGER) AS DATE) END AS delist_date FROM supplier), "
    "lp AS (SELECT *, (SELECT min(pos) FROM cal WHERE session >= list_date) AS start_pos FROM ls), "
    "li AS (SELECT p.entity, p.session, p.pos, p.traded, p.close, list_date IS NOT NULL AND p.session >= list_date AND (delist_date IS NULL OR p.session <= delist_date) AS listed, "
    "greatest(p.pos - start_pos + 1, 0) + CASE WHEN f > list_date THEN (f - list_date) * 5 // 7 ELSE 0 END AS age, NOT p.traded AND p.pos % 2 = 0 AS suspended FROM panel p LEFT JOIN lp USING (entity) CROSS JOIN lf), "
    "lu AS (SELECT li.*, CASE WHEN listed THEN age ELSE 0 END AS list_age, u.is_restricted, u.amount_mean, u.amount_count FROM li JOIN uni u ON u.entity = li.entity AND u.session = li.session), "
    "lr2 AS (SELECT *, concat_ws(';', CASE WHEN NOT listed THEN 'not_listed' END, CASE WHEN listed AND list_age < 60 THEN 'new_stock' END, CASE WHEN is_restricted THEN 'st' END, CASE WHEN suspended THEN 'suspended' END, CASE WHEN NOT (traded AND coalesce(close >= 1000, FALSE)) THEN 'insufficient_price_data' END, CASE WHEN coalesce(amount_mean < 60000, TRUE) OR coalesce(amount_count < 15, TRUE) THEN 'low_liquidity' END) AS exclude_reason FROM lu)"
)


@query("e01_e03_listed_universe", f"{PANEL}, {_LISTED} SELECT entity, session, listed AS is_listed, list_age, exclude_reason, exclude_reason = '' AS in_model_universe FROM lr2")
def listed_universe(spark, sf):
    k = F.col("s_suppkey")
    after = lambda day, n: F.date_add(F.lit(day).cast("date"), n.cast("int"))
    listings = read(spark, sf, "supplier").select(k.alias("entity"), F.when(k % 17 != 0, after("1994-06-01", k % 400 * 5)).alias("list_date"), F.when(k % 5 == 0, after("1999-06-01", k % 200)).alias("delist_date"))
    rows = screened(spark, sf).withColumn("suspended", ~F.col("traded") & (F.col("pos") % 2 == 0))
    out = L.listed_universe(L.listing_flags(rows, listings, calendar(spark, sf)), L.UniverseSettings(60, 60000.0, 1000.0, 15))
    return out.select(*KEY, "is_listed", F.col("list_age").cast("long").alias("list_age"), "exclude_reason", "in_model_universe")


#: What the cascade looks at, made of the panel: codes of all boards, missing tables,
#: prices that contradict each other.
_CANDIDATES = f"{_UNIVERSE}, lr AS (SELECT *, last_value(ret_1d IGNORE NULLS) OVER (PARTITION BY entity ORDER BY pos ROWS UNBOUNDED PRECEDING) AS lr, last_value(close IGNORE NULLS) OVER (PARTITION BY entity ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pc FROM rets), cand AS (SELECT r.entity, r.session, r.pos, round(-lr, 9) AS score, r.pos > 3 AS has_universe, r.pos >= 20 AS in_model_universe, CASE r.grp % 5 WHEN 0 THEN '688' WHEN 1 THEN '300' ELSE '600' END || lpad(CAST(r.entity % 1000 AS VARCHAR), 3, '0') || CASE r.grp % 4 WHEN 0 THEN '.SH' WHEN 1 THEN '.SZ' WHEN 2 THEN '.BJ' ELSE '.SH' END AS code, u.is_restricted AS is_st, NOT r.traded AND r.pos % 2 = 0 AS is_suspended, coalesce(u.amount_mean < 40000, FALSE) AS is_low_liquidity, r.pos - r.entity % 10 AS list_days, r.traded AS has_daily, r.vol % 11 <> 0 AS has_daily_basic, pc IS NOT NULL AS has_stk_limit, open, CASE WHEN r.vol % 13 = 0 THEN low / 2 ELSE high END AS high, low, close, close * r.vol * 10 AS total_mv, r.amount, r.vol / 50 AS turnover_rate, pc * 1.5 AS up_limit, pc * 0.5 AS down_limit FROM lr r JOIN uni u ON u.entity = r.entity AND u.session = r.session WHERE lr IS NOT NULL)"


def candidates(spark, sf):
    e = Window.partitionBy("entity").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    p = L.with_limits(R.with_returns(universe(spark, sf))).withColumn("score", F.round(-F.last("ret_1d", ignorenulls=True).over(e), 9)).where("score IS NOT NULL")
    c = F.col
    board = F.concat(F.when(c("grp") % 5 == 0, "688").when(c("grp") % 5 == 1, "300").otherwise("600"), F.lpad((c("entity") % 1000).cast("string"), 3, "0"), F.when(c("grp") % 4 == 1, ".SZ").when(c("grp") % 4 == 2, ".BJ").otherwise(".SH"))
    return p.select(
        *KEY, "score", (c("pos") > 3).alias("has_universe"), (c("pos") >= 20).alias("in_model_universe"), board.alias("code"), c("is_restricted").alias("is_st"),
        (~c("traded") & (c("pos") % 2 == 0)).alias("is_suspended"), (c("amount_mean") < 40000).alias("is_low_liquidity"), c("age").alias("list_days"), c("traded").alias("has_daily"),
        (c("vol") % 11 != 0).alias("has_daily_basic"), c("up_limit").isNotNull().alias("has_stk_limit"), "open", F.when(c("vol") % 13 == 0, c("low") / 2).otherwise(c("high")).alias("high"),
        "low", "close", (c("close") * c("vol") * 10).alias("total_mv"), "amount", (c("vol") / 50).alias("turnover_rate"), "up_limit", "down_limit",
    )


_CASCADE = (
    "CASE WHEN NOT has_universe THEN 'missing_universe' WHEN NOT in_model_universe THEN 'not_in_model_universe' WHEN code LIKE '%.BJ' THEN 'bj_market' WHEN regexp_full_match(code, '688[0-9]{3}[.]SH') THEN 'star_market' WHEN regexp_full_match(code, '300[0-9]{3}[.]SZ') THEN 'chinext_market' WHEN is_st THEN 'st' WHEN is_suspended THEN 'suspended' WHEN is_low_liquidity THEN 'insufficient_liquidity' WHEN list_days < 60 THEN 'newly_listed' WHEN NOT has_daily THEN 'missing_daily'"
    " WHEN NOT coalesce(has_daily_basic, FALSE) THEN 'missing_daily_basic' WHEN NOT has_stk_limit THEN 'missing_stk_limit' WHEN NOT (open > 0 AND high > 0 AND low > 0 AND close > 0 AND high >= greatest(open, close, low) AND low <= least(open, close)) THEN 'invalid_ohlc' WHEN NOT coalesce(total_mv >= 60000, FALSE) THEN 'insufficient_market_cap' WHEN NOT coalesce(amount >= 25000, FALSE) THEN 'insufficient_daily_amount'"
    " WHEN NOT coalesce(turnover_rate >= 0.5, FALSE) THEN 'insufficient_turnover' WHEN NOT coalesce(turnover_rate <= 2.5, FALSE) THEN 'excessive_turnover' WHEN NOT coalesce(up_limit > down_limit AND down_limit > 0 AND close BETWEEN down_limit - 0.01 AND up_limit + 0.01, FALSE) THEN 'abnormal_price_limits' END"
)


@query("e08_filter_cascade", f"{PANEL}, {_CANDIDATES}, r AS (SELECT entity, session, score, {_CASCADE} AS reason FROM cand), k AS (SELECT *, CASE WHEN reason IS NULL THEN row_number() OVER (PARTITION BY session, reason IS NULL ORDER BY score DESC, entity) END AS rank FROM r) SELECT CASE WHEN rank > 3 THEN 'below_candidate_cutoff' ELSE reason END AS reason, count(*) AS n, round(sum(score), 4) AS total FROM k GROUP BY 1", digits=4)
def cascade(spark, sf):
    rules = L.candidate_rules(L.CandidateSettings(60, 60000.0, 25000.0, 0.5, 2.5))
    return L.filter_cascade(candidates(spark, sf), rules, "score", 3).groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("total"))


def in_base(rows):
    return rows.withColumn("in_base", (F.col("grp") < 22) & (F.col("pos") > F.col("entity") % 7) & (F.col("pos") <= 345 + F.col("entity") % 11))


def base_panel(spark, sf):
    return in_base(limited(spark, sf))


def labels(spark, sf):
    return L.forward_labels(base_panel(spark, sf), H, parts=parts(spark, sf))


_LABELS = (
    f"{_LIMITS}, ahead AS ("
    + " UNION ALL ".join(
        f"SELECT entity, session, pos, {h} AS horizon, lead({_BASE}) OVER e AS entry_in_base, lead({_BASE}, {1 + h}) OVER e AS exit_in_base, lead(session) OVER e AS entry_session, lead(open) OVER e AS entry_open, lead(traded) OVER e AS entry_traded, lead(up_limit) OVER e AS entry_up_limit, lead(bench) OVER e AS entry_bench, lead(session, {1 + h}) OVER e AS exit_session, lead(open, {1 + h}) OVER e AS exit_open, lead(traded, {1 + h}) OVER e AS exit_traded, lead(down_limit, {1 + h}) OVER e AS exit_down_limit, lead(bench, {1 + h}) OVER e AS exit_bench FROM lim WINDOW e AS (PARTITION BY entity ORDER BY pos)"
        for h in H
    )
    + "), reasoned AS (SELECT *, CASE WHEN entry_session IS NULL OR exit_session IS NULL THEN 'insufficient_future_calendar' WHEN NOT coalesce(entry_in_base, FALSE) THEN 'entry_not_in_base_universe' WHEN NOT coalesce(entry_open > 0, FALSE) THEN 'missing_entry_price' WHEN NOT coalesce(exit_open > 0, FALSE) THEN 'missing_exit_price' WHEN NOT coalesce(entry_traded, FALSE) THEN 'entry_suspended' WHEN entry_open >= entry_up_limit - 1e-6 THEN 'entry_not_buyable' WHEN NOT coalesce(exit_in_base, FALSE) THEN 'exit_not_in_base_universe' WHEN NOT coalesce(exit_traded, FALSE) THEN 'exit_suspended' WHEN exit_open <= exit_down_limit + 1e-6 THEN 'exit_not_sellable' WHEN NOT coalesce(entry_bench > 0, FALSE) OR NOT coalesce(exit_bench > 0, FALSE) THEN 'missing_benchmark_price' END AS reason FROM ahead), labels0 AS (SELECT *, reason IS NULL AS is_label_available, CASE WHEN reason IS NULL THEN exit_open / entry_open - 1 END AS forward_ret, CASE WHEN reason IS NULL THEN exit_bench / entry_bench - 1 END AS benchmark_forward_ret FROM reasoned), labels1 AS (SELECT *, forward_ret - benchmark_forward_ret AS future_excess_ret FROM labels0), labels2 AS (SELECT *, CASE WHEN future_excess_ret IS NOT NULL THEN (rank() OVER (PARTITION BY session, horizon ORDER BY future_excess_ret NULLS LAST) + (count(*) OVER (PARTITION BY session, horizon, future_excess_ret) - 1) / 2.0) / count(future_excess_ret) OVER (PARTITION BY session, horizon) END AS label_pct FROM labels1), labels AS (SELECT *, CAST(CASE WHEN label_pct IS NOT NULL THEN greatest(0, least(4, floor((label_pct - 1e-12) * 5))) END AS INTEGER) AS label_quantile FROM labels2)"
)


@query("h01_h07_labels", f"{PANEL}, {_LABELS} SELECT entity, session, horizon, entry_session, exit_session, reason, is_label_available, round(forward_ret, 6) AS forward_ret, round(benchmark_forward_ret, 6) AS benchmark_forward_ret, round(future_excess_ret, 6) AS future_excess_ret, round(label_pct, 6) AS label_pct, label_quantile FROM labels")
def forward(spark, sf):
    return labels(spark, sf).select(*KEY, "horizon", "entry_session", "exit_session", "reason", "is_label_available", "forward_ret", "benchmark_forward_ret", "future_excess_ret", "label_pct", "label_quantile")


@query("h06_delayed_exit", f"{PANEL}, {_LIMITS} SELECT entity, session, min(CASE WHEN traded AND NOT is_limit_down THEN pos END) OVER (PARTITION BY entity ORDER BY pos ROWS BETWEEN 6 FOLLOWING AND 9 FOLLOWING) AS exit_pos FROM trad")
def delayed(spark, sf):
    return L.delayed_exit(L.tradability(limited(spark, sf)), 5, 3).select(*KEY, F.col("exit_pos").cast("long").alias("exit_pos"))


@query("h08_label_availability", f"{PANEL}, {_LABELS} SELECT horizon, " + ", ".join(f"count(*) FILTER (session BETWEEN {a} AND {b}) AS {p}_rows, count(*) FILTER (session BETWEEN {a} AND {b} AND is_label_available) AS {p}_available, min(session) FILTER (session BETWEEN {a} AND {b} AND is_label_available) AS {p}_first, max(session) FILTER (session BETWEEN {a} AND {b} AND is_label_available) AS {p}_last" for p, a, b in (("selection", "DATE '1995-01-01'", "DATE '1999-12-31'"), ("test", "DATE '2000-01-01'", "DATE '2009-01-01'"))) + " FROM labels GROUP BY horizon")
def availability(spark, sf):
    return L.label_availability(labels(spark, sf), {"selection": ("1995-01-01", "1999-12-31"), "test": ("2000-01-01", "2009-01-01")})


@query("h09_reconcile_counts", f"{PANEL}, {_LABELS}, w AS (SELECT session, horizon, count(*) AS expected FROM panel, (SELECT unnest([1, 5]) AS horizon) WHERE {_BASE} GROUP BY 1, 2), f AS (SELECT session, horizon, count(*) AS found FROM labels GROUP BY 1, 2) SELECT session, horizon, expected, coalesce(found, 0) AS found FROM w LEFT JOIN f USING (session, horizon) WHERE expected <> coalesce(found, 0)")
def reconcile(spark, sf):
    return L.reconcile_counts(labels(spark, sf), base_panel(spark, sf), H)


@query("h10_label_audit", f"{PANEL}, {_LABELS} SELECT count(*) AS n, count(l.entity) AS matched, round(avg(CAST(coalesce(is_label_available, FALSE) AS INTEGER)), 6) AS available_ratio, count(*) FILTER (entry_session <= b.session OR exit_session <= entry_session) AS violations FROM (SELECT entity, session FROM bars WHERE vol > 60) b LEFT JOIN (SELECT * FROM labels WHERE horizon = 5) l ON l.entity = b.entity AND l.session = b.session")
def audit(spark, sf):
    return L.label_audit(bars(spark, sf).where("vol > 60").select(*KEY), labels(spark, sf).where("horizon = 5"))


@query("d08_eligible_labels", sql_rounded(f"SELECT r.entity, r.session, horizon, ret_1d, future_excess_ret FROM rets r JOIN labels l ON l.entity = r.entity AND l.session = r.session JOIN uni u ON u.entity = r.entity AND u.session = r.session WHERE is_label_available AND NOT is_new AND NOT is_restricted AND u.traded AND amount_mean >= 60000", "entity, session, horizon", ["ret_1d", "future_excess_ret"]).replace(", x AS (", f", {_LABELS}, {_UNIVERSE}, x AS (", 1))
def eligible(spark, sf):
    f = R.with_returns(panel(spark, sf)).select(*KEY, "ret_1d")
    return J.eligible_labels(f, labels(spark, sf).select(*KEY, "horizon", "future_excess_ret"), universe(spark, sf), "future_excess_ret")
