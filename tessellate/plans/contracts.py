"""Queries over table contracts and the rest of the universe rules (E6, F20, J7, J9,
J10, J17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import fundamentals as N
from ..operators import labels as L
from ..operators import monitor as M
from ..operators import quality as Q
from .base import PANEL, panel, query, read
from .labelling import _LABELS, _LIMITS, _REPORTS, _UNIVERSE, labels, limited, reports, universe
from .metrics import _OBSERVED, observations

KEY = ["entity", "session"]


def _counts(table: str, rules: dict[str, str], source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{table}' AS \"table\", '{n}' AS rule, count(*) FILTER ({c}) AS violations FROM {source}" for n, c in rules.items())


@query("e06_latest_only_flag", f"{PANEL} SELECT p.entity, p.session, coalesce(s_acctbal < 0, FALSE) AND p.session = (SELECT max(session) FROM cal) AS restricted FROM panel p LEFT JOIN supplier ON s_suppkey = p.entity")
def latest_only(spark, sf):
    now = read(spark, sf, "supplier").where("s_acctbal < 0").select(F.col("s_suppkey").alias("entity"))
    return L.latest_only_flag(panel(spark, sf), now).select(*KEY, "restricted")


_INDICATORS = {"roe": "x / 100000", "roa": "x / 200000", "grossprofit_margin": "(rev % 97) / 97", "netprofit_margin": "(rev % 89) / 89", "revenue_yoy": "CAST(rev % 53 - 26 AS DOUBLE)", "netprofit_yoy": "CAST(rev % 31 - 15 AS DOUBLE)"}
_BALANCE = {"total_assets": "x * 3", "total_liab": "x * (rev % 7) / 7", "total_cur_assets": "x", "total_cur_liab": "CAST(rev % 5 * 1000 AS DOUBLE)"}


def _announced_sql(name: str, values: dict[str, str], where: str, deltas: tuple[str, ...] = ()) -> str:
    """The tables n_all (a row for each entity, period and date) and n (the latest period of each date)."""
    more = "".join(f", {c} - lag({c}) OVER (PARTITION BY entity ORDER BY available, period) AS {c}_delta" for c in deltas)
    cols = ", ".join(f"{v} AS {c}" for c, v in values.items())
    return (
        f"{name}_all AS (SELECT *{more} FROM (SELECT entity, period, coalesce(fin, ann) AS available, {cols} FROM reports WHERE {where} QUALIFY row_number() OVER (PARTITION BY entity, period, coalesce(fin, ann) ORDER BY rev DESC) = 1)), "
        f"{name} AS (SELECT * FROM {name}_all QUALIFY row_number() OVER (PARTITION BY entity, available ORDER BY period DESC) = 1)"
    )


_LAST = "(SELECT * FROM {0}_all QUALIFY row_number() OVER (PARTITION BY entity, period ORDER BY available DESC) = 1)"
_FUNDAMENTAL = ", ".join(
    [
        _REPORTS,
        _announced_sql("ind", _INDICATORS, "rev % 2 = 0", N.CHANGES),
        _announced_sql("inc", {"n_income": "x - 100000"}, "rev % 3 > 0"),
        _announced_sql("bal", _BALANCE, "rev % 3 = 0"),
        _announced_sql("cash", {"n_cashflow_act": "x / 2"}, "rev % 2 = 1"),
        f"ocf AS (SELECT i.entity, greatest(c.available, i.available) AS available, c.n_cashflow_act / nullif(i.n_income, 0) AS ocf_to_profit FROM {_LAST.format('cash')} c JOIN {_LAST.format('inc')} i ON i.entity = c.entity AND i.period = c.period QUALIFY row_number() OVER (PARTITION BY i.entity, greatest(c.available, i.available) ORDER BY i.period DESC) = 1)",
    ]
)


@query(
    "f20_fundamental_features",
    f"{PANEL}, {_FUNDAMENTAL} SELECT p.entity, p.session, "
    + ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in [*_INDICATORS, *[f"{c}_delta" for c in N.CHANGES], "ocf_to_profit"])
    + ", round(total_liab / nullif(total_assets, 0), 6) + 0.0 AS debt_to_assets, round(total_cur_assets / nullif(total_cur_liab, 0), 6) + 0.0 AS current_ratio FROM panel p "
    + " ".join(f"ASOF LEFT JOIN {t} ON {t}.entity = p.entity AND p.session >= {t}.available" for t in ("ind", "bal", "ocf")),
)
def fundamental_features(spark, sf):
    r = reports(spark, sf).withColumnsRenamed({"ann": "announced", "fin": "final", "rev": "revision"})

    def table(values, where, changes=()):
        named = [F.expr(v.replace("rev", "revision")).alias(c) for c, v in values.items()]
        rows = r.where(where).select("entity", "period", "announced", "final", "revision", *named)
        return N.announced(rows, changes).drop("announced", "final", "revision")

    income, cash = table({"n_income": "x - 100000"}, "revision % 3 > 0"), table({"n_cashflow_act": "x / 2"}, "revision % 2 = 1")
    tables = {"indicators": table(_INDICATORS, "revision % 2 = 0", N.CHANGES), "balance": table(_BALANCE, "revision % 3 = 0"), "cash": N.cash_to_profit(income, cash)}
    return N.fundamental_features(panel(spark, sf), tables)


@query("f20_fundamentals", f"WITH {_REPORTS}, a AS (SELECT entity, ann AS available, sum(x) AS total, max(x) AS top FROM reports GROUP BY 1, 2) SELECT entity, available, round(top / total, 6) AS top_share, round(top / total - lag(top / total) OVER (PARTITION BY entity ORDER BY available), 6) AS top_share_change FROM a")
def fundamentals(spark, sf):
    a = reports(spark, sf).groupBy("entity", F.col("ann").alias("available")).agg(F.sum("x").alias("total"), F.max("x").alias("top"))
    return L.fundamental_ratios(a, {"top_share": ("top", "total")}, ["top_share"]).select("entity", "available", "top_share", "top_share_change")


_Q = f"{_LIMITS}, ql AS (SELECT entity, session, traded, CASE pos % 50 WHEN 0 THEN 0 WHEN 1 THEN 99999.99 WHEN 2 THEN down_limit / 2 WHEN 3 THEN -1 ELSE up_limit END AS u, CASE pos % 50 WHEN 0 THEN 0 WHEN 1 THEN 0 ELSE down_limit END AS d FROM lim)"


@query("j07_limit_quality", f"{PANEL}, {_Q} " + _counts("limits", {"null": "u IS NULL OR d IS NULL", "sentinel": "abs(u - 99999.99) < 1e-6 AND abs(d) < 1e-6", "zero": "u = 0 AND d = 0", "inverted": "u < d AND NOT (u = 0 AND d = 0)", "not_positive": "(u <= 0 OR d < 0) AND NOT (u = 0 AND d = 0)", "zero_not_suspended": "u = 0 AND d = 0 AND traded"}, "ql"))
def limit_quality(spark, sf):
    k = F.col("pos") % 50
    p = limited(spark, sf).withColumns(
        {
            "u": F.when(k == 0, 0.0).when(k == 1, 99999.99).when(k == 2, F.col("down_limit") / 2).when(k == 3, -1.0).otherwise(F.col("up_limit")),
            "d": F.when(k.isin(0, 1), 0.0).otherwise(F.col("down_limit")),
        }
    )
    rows = p.select(*KEY, F.col("u").alias("up_limit"), F.col("d").alias("down_limit"))
    return Q.limit_quality(rows, p.where("NOT traded"))


@query("j09_universe_invariants", f"{PANEL}, {_UNIVERSE}, r AS (SELECT u.*, coalesce(amount_mean < 60000, TRUE) AS thin FROM uni u), q AS (SELECT *, NOT is_new AND NOT is_restricted AND traded AND NOT thin AS m FROM r), w AS (SELECT *, m OR entity % 50 = 7 AS mm FROM q) " + _counts("universe", {"model_but_new": "mm AND is_new", "model_but_restricted": "mm AND is_restricted", "model_without_price": "mm AND NOT traded", "model_but_illiquid": "mm AND thin", "reason_missing": "FALSE", "reason_needless": "mm AND NOT m", "price_without_trade": "FALSE", "key_missing": "entity IS NULL"}, "w"))
def universe_invariants(spark, sf):
    u = universe(spark, sf).withColumn("in_model_universe", F.col("in_model_universe") | (F.col("entity") % 50 == 7))
    return Q.rule_table(u, Q.universe_rules(), "universe")


@query("j10_label_invariants", f"{PANEL}, {_LABELS}, q AS (SELECT *, CASE WHEN entity % 40 = 3 THEN session ELSE entry_session END AS en, CASE WHEN entity % 40 = 5 THEN 'odd' ELSE reason END AS re FROM labels) " + _counts("labels", {"entry_not_after_signal": "en <= session", "exit_not_after_entry": "exit_session <= en", "available_without_return": "is_label_available AND future_excess_ret IS NULL", "return_without_label": "NOT is_label_available AND future_excess_ret IS NOT NULL", "reason_unknown": "re = 'odd'", "reason_missing": "NOT is_label_available AND re IS NULL", "percentile_out_of_range": "label_pct <= 0 OR label_pct > 1", "quantile_out_of_range": "label_quantile < 0 OR label_quantile >= 5"}, "q"))
def label_invariants(spark, sf):
    rows = labels(spark, sf).withColumns({"entry_session": F.when(F.col("entity") % 40 == 3, F.col("session")).otherwise(F.col("entry_session")), "reason": F.when(F.col("entity") % 40 == 5, "odd").otherwise(F.col("reason"))})
    return Q.rule_table(rows, Q.label_rules([n for n, _ in L.label_reasons()], 5), "labels")


def labelled(spark, sf):
    return M.attach_labels(observations(spark, sf), labels(spark, sf))


def _labelled_sql(store: str) -> str:
    """Observations with the labels of a store."""
    return f"{_OBSERVED}, ob AS (SELECT m.*, CASE WHEN l.entity IS NULL THEN 'pending' WHEN l.is_label_available AND l.future_excess_ret IS NOT NULL THEN 'available' ELSE 'unavailable' END AS label_status, l.reason AS label_reason, CASE WHEN l.is_label_available THEN l.future_excess_ret END AS y, sha256(concat_ws('|', model_id, CAST(m.session AS VARCHAR), CAST(m.entity AS VARCHAR), CAST(m.horizon AS VARCHAR))) AS observation_id FROM m LEFT JOIN {store} l ON l.entity = m.entity AND l.session = m.session AND l.horizon = m.horizon WHERE m.exit_session <= DATE '2000-01-01')"


#: j17 counts what holds with any store of labels; its SQL has one that ends early.
_LABELLED = _labelled_sql("(SELECT * FROM labels WHERE session < DATE '1999-07-01')")


@query("l03_label_status", f"{PANEL}, {_labelled_sql('labels')} SELECT model_id, horizon, label_status, label_reason, count(*) AS n, round(sum(y), 4) AS total FROM ob GROUP BY 1, 2, 3, 4", digits=4)
def label_status(spark, sf):
    return labelled(spark, sf).groupBy("model_id", "horizon", "label_status", "label_reason").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("total"))


@query(
    "j17_observation_contract",
    f"{PANEL}, {_LABELLED}, ch AS (SELECT *, CASE WHEN entity % 6 = 1 THEN 'shadow' WHEN model_id = 'a' THEN 'champion' ELSE 'ensemble' END AS mrole, CASE WHEN entity % 8 = 2 THEN '' ELSE observation_id END AS oid FROM ob), tw AS (SELECT * FROM ch UNION ALL SELECT * FROM ch WHERE entity % 7 = 3) "
    + _counts("observations", {"role_unknown": "mrole = 'shadow'", "horizon_not_positive": "horizon <= 0", "immature": "exit_session > DATE '1998-06-30'", "signal_not_before_exit": "session >= exit_session", "future_signal": "session > DATE '1998-06-30'", "id_missing": "oid = ''", "return_mismatch": "(label_status = 'available') <> (y IS NOT NULL)"}, "tw")
    + " UNION ALL SELECT 'observations', 'duplicate_key', CAST(sum(k - 1) AS BIGINT) FROM (SELECT count(*) AS k FROM tw GROUP BY model_id, entity, session, horizon)",
)
def observation_contract(spark, sf):
    role = F.when(F.col("entity") % 6 == 1, "shadow").when(F.col("model_id") == "a", "champion").otherwise("ensemble")
    o = labelled(spark, sf).withColumns({"model_role": role, "observation_id": F.when(F.col("entity") % 8 == 2, "").otherwise(F.col("observation_id"))})
    o = o.unionByName(o.where("entity % 7 = 3"))
    twice = Q.duplicate_rows(o, ["model_id", *KEY, "horizon"]).select(F.lit("observations").alias("table"), F.lit("duplicate_key").alias("rule"), F.col("n").alias("violations"))
    return Q.rule_table(o, Q.observation_rules("1998-06-30"), "observations").unionByName(twice)
