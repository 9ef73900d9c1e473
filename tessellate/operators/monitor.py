"""Metrics of ledgers and score histories, and threshold alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import avg_rank_pct, bucketize, corr_of, safe_div


def trade_costs(rows: DataFrame, value: str, is_sell: Column, rate: float = 0.0003, least: float = 5.0, slip: float = 0.001) -> DataFrame:
    """Commission with a minimum, stamp duty on sells, transfer fee, slippage,
    at the rates (stamp, fee) in force on the row."""
    return rows.withColumns({"commission": F.greatest(F.lit(least), F.col(value) * rate), "stamp_duty": F.when(is_sell, F.col(value) * F.col("stamp")).otherwise(0.0), "transfer_fee": F.col(value) * F.col("fee"), "slippage": F.col(value) * slip})


def expand_horizons(rows: DataFrame, horizons: Sequence[int]) -> DataFrame:
    """L1: ensemble rows stand for every horizon, others for their own."""
    each = F.when(F.col("model_role") == "ensemble", F.array(*[F.lit(h) for h in horizons])).otherwise(F.array("horizon"))
    return rows.withColumn("horizon", F.explode(each))


def mature(rows: DataFrame, exits: DataFrame, as_of: str) -> DataFrame:
    """L2: rows whose exit session is known and not after as_of."""
    return rows.join(exits.select("session", "horizon", "exit_session"), ["session", "horizon"]).where(F.col("exit_session") <= F.to_date(F.lit(as_of)))


def observation_ids(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """L3: a stable id of each observation, SHA-256 over its key."""
    return rows.withColumn("observation_id", F.sha2(F.concat_ws("|", *[F.col(k).cast("string") for k in key]).cast("binary"), 256))


def attach_labels(rows: DataFrame, labels: DataFrame, key: Sequence[str] = ("entity", "session", "horizon")) -> DataFrame:
    """L3: observations with their label: `label_status` is available, unavailable (the
    label's reason says why) or pending where there is no label yet, and `y` is there
    just when it is available. A label without a return counts as unavailable."""
    own = labels.select(*key, F.col("future_excess_ret").alias("_y"), F.col("is_label_available").alias("_ok"), F.col("reason").alias("label_reason"))
    ok = F.coalesce(F.col("_ok"), F.lit(False)) & F.col("_y").isNotNull()
    both = rows.join(own, list(key), "left").withColumn("label_status", F.when(F.col("_ok").isNull(), "pending").when(ok, "available").otherwise("unavailable"))
    return both.withColumn("y", F.when(ok, F.col("_y"))).drop("_y", "_ok")


def daily_performance(rows: DataFrame, by: Sequence[str], sizes: Sequence[int] = (10, 20, 50)) -> DataFrame:
    """L4: of (score, rank, y): rank IC, hit rate, and for each list size the mean
    return and hit rate of its rows."""
    from .diagnostics import daily_ic

    ic = daily_ic(rows.withColumn("x", F.col("score")), by, 3).select(*by, "rank_ic")
    hit = lambda c: F.avg(F.when(c & F.col("y").isNotNull(), (F.col("y") > 0).cast("double")))
    aggs = [hit(F.lit(True)).alias("hit_rate")]
    for k in sizes:
        inside = F.col("rank") <= k
        aggs += [F.avg(F.when(inside, F.col("y"))).alias(f"top{k}_ret"), hit(inside).alias(f"top{k}_hit")]
    return rows.groupBy(*by).agg(*aggs).join(ic, list(by), "left")


def recent_means(daily: DataFrame, by: Sequence[str], value: str, windows: Sequence[int] = (20, 60, 120)) -> DataFrame:
    """The mean over all sessions and the last ones, and the ratio of the
    last to all, null where that has no meaning."""
    r = daily.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("session"))))
    out = r.groupBy(*by).agg(F.avg(value).alias("all_mean"), *[F.avg(F.when(F.col("_r") <= w, F.col(value))).alias(f"last_{w}_mean") for w in windows])
    return out.withColumns({f"decay_{w}": F.when(F.abs("all_mean") > 1e-12, F.col(f"last_{w}_mean") / F.col("all_mean")) for w in windows})


def decile_returns(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean return of each score decile over all rows of a group."""
    d = bucketize("score_percentile", 10, "decile")
    return rows.where("y IS NOT NULL").withColumn("decile", d).groupBy(*by, "decile").agg(F.avg("y").alias("mean_ret"), F.count(F.lit(1)).alias("n"))


def monotonicity(deciles: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rank correlation of the bucket with its mean return."""
    r = deciles.withColumns({"_d": avg_rank_pct("decile", by), "_m": avg_rank_pct("mean_ret", by)})
    return r.groupBy(*by).agg(corr_of("_d", "_m").alias("monotonicity"))


def latest_state(events: DataFrame, key: Sequence[str], order: Sequence[str], values: Sequence[str], as_of: Column | None = None) -> DataFrame:
    """The values of each key's last event."""
    rows = events if as_of is None else events.where(as_of)
    return rows.groupBy(*key).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_v")).select(*key, "_v.*")


def equity_curve(flows: DataFrame, by: str, date: str, cash: str, start: float) -> DataFrame:
    """Equity after each day's flows, its net value, daily return, and
    drawdown under the running peak."""
    w = Window.partitionBy(by).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    out = flows.groupBy(by, date).agg(F.sum(cash).alias("flow")).withColumn("equity", F.lit(start) + F.sum("flow").over(w))
    before = F.coalesce(F.lag("equity").over(Window.partitionBy(by).orderBy(date)), F.lit(start))
    peak = F.greatest(F.lit(start), F.max("equity").over(w))
    return out.withColumns({"nav": F.col("equity") / start, "daily_return": safe_div("equity", before) - 1, "drawdown": safe_div("equity", peak) - 1})


def weights(positions: DataFrame, by: str, value: str, top: int = 5) -> DataFrame:
    """The largest weight and that of the largest `top` positions."""
    w = Window.partitionBy(by)
    p = positions.withColumn("_w", safe_div(value, F.sum(value).over(w))).withColumn("_r", F.row_number().over(w.orderBy(F.desc(value), "entity")))
    return p.groupBy(by).agg(F.max("_w").alias("max_weight"), F.sum(F.when(F.col("_r") <= top, F.col("_w")).otherwise(0.0)).alias("top_concentration"), F.count(F.lit(1)).alias("n_positions"))


def order_outcomes(trades: DataFrame, by: Sequence[str]) -> DataFrame:
    """Of orders (side, status, value, cost): filled and rejected ones by
    side, write-offs, the shares that were rejected or failed, what was traded and what
    it cost."""
    done, side = F.col("status") == "filled", lambda s, k: F.count_if((F.col("status") == s) & (F.col("side") == k))
    return trades.groupBy(*by).agg(
        side("filled", "buy").alias("filled_buys"), side("filled", "sell").alias("filled_sells"), side("rejected", "buy").alias("rejected_buys"), side("rejected", "sell").alias("rejected_sells"),
        F.count_if(F.col("status") == "terminal_writeoff").alias("write_offs"), F.avg((F.col("status") == "rejected").cast("double")).alias("rejected_ratio"), F.avg((F.col("status") == "failed").cast("double")).alias("failed_ratio"),
        F.sum(F.when(done, F.col("value")).otherwise(0.0)).alias("traded"), F.sum(F.when(done, F.col("cost")).otherwise(0.0)).alias("total_cost"),
    )


def portfolio_metrics(curve: DataFrame, trades: DataFrame, by: str, date: str, start: float) -> DataFrame:
    """A portfolio's last day: nav, daily return, drawdown and the worst one (peaks
    are those of the curve), and that day's turnover, cost and rejections over the
    equity before."""
    w = Window.partitionBy(by).orderBy(date)
    c = curve.withColumns({"_dd": safe_div("equity", F.max("equity").over(w.rowsBetween(Window.unboundedPreceding, 0))) - 1, "_before": F.coalesce(F.lag("equity").over(w), F.lit(start))})
    last = c.groupBy(by).agg(F.max(date).alias(date), F.max_by(F.struct("equity", "daily_return", "_dd", "_before"), date).alias("_l"), F.min("_dd").alias("max_drawdown"))
    both = last.join(order_outcomes(trades, [by, date]), [by, date], "left")
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    return both.select(
        by, date, (F.col("_l.equity") / start).alias("nav"), F.col("_l.daily_return").alias("daily_return"), F.col("_l._dd").alias("drawdown"), "max_drawdown",
        zero(F.when(F.col("_l._before") > 0, F.col("traded") / F.col("_l._before"))).alias("turnover"), zero(F.when(F.col("_l._before") > 0, F.col("total_cost") / F.col("_l._before"))).alias("cost_ratio"), zero(F.col("rejected_ratio")).alias("rejected_ratio"),
    )


def accounting_summary(curve: DataFrame, trades: DataFrame, by: str, date: str) -> DataFrame:
    """Costs and order counts of a portfolio, its best and worst daily return, and
    the largest change of its equity from one day to the next."""
    jump = F.abs(F.col("equity") - F.lag("equity").over(Window.partitionBy(by).orderBy(date)))
    ends = curve.withColumn("_j", jump).groupBy(by).agg(F.max("daily_return").alias("best_day"), F.min("daily_return").alias("worst_day"), F.coalesce(F.max("_j"), F.lit(0.0)).alias("largest_jump"))
    return order_outcomes(trades, [by]).drop("rejected_ratio", "failed_ratio", "traded").join(ends, by)


def ledger_rules(tolerance: float = 1e-6) -> dict[str, Column]:
    """What rows (cash, holdings, equity) of an unlevered book break."""
    c = F.col
    values = (c("cash"), c("holdings"), c("equity"))
    return {
        "not_finite": sum((F.coalesce(F.isnan(v) | (F.abs(v) == float("inf")), F.lit(True)).cast("int") for v in values), F.lit(0)) > 0,
        "negative": F.least(*values) < -tolerance,
        "not_reconciled": F.abs(c("equity") - c("cash") - c("holdings")) > tolerance + 1e-10 * F.abs(c("cash") + c("holdings")),
    }


def lifecycle_violations(trades: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row: positions that are sold before they are bought, sales of more than
    is held, and orders with negative shares or costs."""
    w = Window.partitionBy(*key).orderBy(*order)
    signed = F.when(F.col("side") == "buy", F.col("shares")).otherwise(-F.col("shares"))
    t = trades.withColumns({"_held": F.sum(signed).over(w.rowsBetween(Window.unboundedPreceding, 0)), "_n": F.row_number().over(w)})
    return t.agg(F.count_if((F.col("_n") == 1) & (F.col("side") == "sell")).alias("sold_first"), F.count_if((F.col("side") == "sell") & (F.col("_held") < -1e-9)).alias("oversold"), F.count_if((F.col("shares") < 0) | (F.col("cost") < 0)).alias("negative"))


def closed_trades(trades: DataFrame, key: str) -> DataFrame:
    """Of fills (key, side, date, value): profit and days held of positions with
    both sides."""
    one = trades.groupBy(key).agg(F.sum(F.when(F.col("side") == "buy", F.col("value"))).alias("paid"), F.sum(F.when(F.col("side") == "sell", F.col("value"))).alias("got"), F.min(F.when(F.col("side") == "buy", F.col("date"))).alias("opened"), F.max(F.when(F.col("side") == "sell", F.col("date"))).alias("closed"))
    return one.where("paid IS NOT NULL AND got IS NOT NULL").select(key, (F.col("got") - F.col("paid")).alias("pnl"), F.datediff("closed", "opened").alias("days"))


def trade_summary(closed: DataFrame) -> DataFrame:
    """Win rate, mean win over mean loss, how long positions were held, and the
    best and worst of them."""
    win, loss = F.avg(F.when(F.col("pnl") > 0, F.col("pnl"))), F.avg(F.when(F.col("pnl") < 0, -F.col("pnl")))
    return closed.agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("pnl") > 0).cast("double")).alias("win_rate"), (win / loss).alias("profit_loss_ratio"), F.avg("days").alias("days_mean"), F.percentile("days", F.lit(0.5)).alias("days_median"), F.percentile("days", F.lit(0.95)).alias("days_p95"), F.max("pnl").alias("best"), F.min("pnl").alias("worst"))


def ledger_violations(trades: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Fills that leave a negative holding, with what was held before."""
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    signed = F.when(F.col("side") == "buy", F.col("shares")).otherwise(-F.col("shares"))
    return trades.withColumn("held", F.sum(signed).over(w)).where("held < 0")


def stale_marks(panel: DataFrame) -> DataFrame:
    """The last known close and how many sessions old it is."""
    w = Window.partitionBy("entity").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    out = panel.withColumns({"mark": F.last("close", ignorenulls=True).over(w), "_p": F.max(F.when(F.col("close").isNotNull(), F.col("pos"))).over(w)})
    out = out.withColumn("stale_sessions", F.col("pos") - F.col("_p"))
    return out.withColumn("mark_status", F.when(F.col("_p").isNull(), "none").when(F.col("stale_sessions") > 0, "stale").otherwise("fresh")).drop("_p")


def trailing_volatility(rows: DataFrame, n: int, least: int) -> DataFrame:
    """Deviation of each entity's last n returns, null below `least`."""
    r = rows.where("ret_1d IS NOT NULL").withColumn("_r", F.row_number().over(Window.partitionBy("entity").orderBy(F.desc("session")))).where(F.col("_r") <= n)
    return r.groupBy("entity").agg(F.when(F.count(F.lit(1)) >= least, F.stddev_pop("ret_1d")).alias("volatility"), F.count(F.lit(1)).alias("n"))


def risk_flags(rules: Sequence[tuple[str, Column]]) -> Column:
    """The names of the rules that hold, as an array."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules]))


def watch_table(rows: DataFrame, keys: Sequence[str], rules: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """For each rule (name, value, condition) whether it is met, watched or
    unavailable."""
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(v).cast("double").alias("value"), F.when(F.col(v).isNull(), "unavailable").when(c, "met").otherwise("watch").alias("status")) for n, v, c in rules]))
    return rows.select(*keys, each.alias("w")).select(*keys, "w.*")


def banded_counts(rows: DataFrame, value: str, bands: Sequence[tuple[str, float]]) -> DataFrame:
    """Rows in each band (name, upper bound; the last is open), also empty ones."""
    band = F.lit(bands[-1][0])
    for name, upper in reversed(bands[:-1]):
        band = F.when(F.col(value) < upper, F.lit(name)).otherwise(band)
    every = rows.sparkSession.createDataFrame([(n,) for n, _ in bands], "band string")
    have = rows.where(F.col(value).isNotNull()).groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n"))
    return every.join(have, "band", "left").select("band", F.coalesce("n", F.lit(0)).alias("n"))


def distributions(rows: DataFrame, categories: Sequence[str], sizes: dict[str, Sequence[tuple[str, float]]]) -> DataFrame:
    """(column, name, n): the rows of each category, missing ones as Unknown, and of each
    size band (name, upper bound; the last is open), empty ones and `missing` included. All
    columns are counted in one pass over the rows."""
    told = [F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit("Unknown")).alias("name")) for c in categories]
    every: list[tuple[str, str]] = []
    for c, bands in sizes.items():
        band = F.lit(bands[-1][0])
        for name, upper in reversed(bands[:-1]):
            band = F.when(F.col(c) < upper, F.lit(name)).otherwise(band)
        real = F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
        told.append(F.struct(F.lit(c).alias("column"), F.when(real, band).otherwise("missing").alias("name")))
        every += [(c, name) for name, _ in bands] + [(c, "missing")]
    counted = rows.select(F.explode(F.array(*told)).alias("x")).groupBy("x.column", "x.name").agg(F.count(F.lit(1)).alias("n"))
    frame = rows.sparkSession.createDataFrame(every, "column string, name string")
    return frame.join(counted, ["column", "name"], "full").select("column", "name", F.coalesce("n", F.lit(0)).alias("n"))


def alerts(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """Of (subject, metric, value): a row for each breached rule (metric,
    direction, warning, critical) with its severity. Rules are a short table."""
    both = metrics.join(F.broadcast(rules), "metric").where("value IS NOT NULL")
    past = lambda t: F.when(F.col("direction") == "above", F.col("value") >= F.col(t)).otherwise(F.col("value") <= F.col(t))
    return both.withColumn("severity", F.when(past("critical"), "critical").when(past("warning"), "warning")).where("severity IS NOT NULL")


def alert_lifecycle(breaches: DataFrame, days: DataFrame) -> DataFrame:
    """Replays evaluations: NEW on the first day of an island of breaches, ACTIVE
    within it, RECOVERED on the first clear day after, each with the island's start.
    days has every evaluated (subject, metric, day)."""
    w = Window.partitionBy("subject", "metric").orderBy("day")
    rows = days.join(breaches.select("subject", "metric", "day", "severity"), ["subject", "metric", "day"], "left").withColumn("_b", F.col("severity").isNotNull())
    rows = rows.withColumn("_was", F.coalesce(F.lag("_b").over(w), F.lit(False)))
    rows = rows.withColumn("state", F.when(F.col("_b") & ~F.col("_was"), "NEW").when(F.col("_b"), "ACTIVE").when(F.col("_was"), "RECOVERED"))
    first = F.last(F.when(F.col("state") == "NEW", F.col("day")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("first_seen", first).where("state IS NOT NULL").select("subject", "metric", "day", "state", "first_seen", "severity")
