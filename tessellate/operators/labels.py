"""Universe rules and forward-return labels of a dense panel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import avg_rank_pct, bucketize, by_entity, safe_div
from .calendar import session_age

TOLERANCE = 1e-6
EXIT = ("session", "open", "traded", "in_base", "down_limit", "bench")
#: A pair of limits that stands for no limit.
NO_LIMIT = (99999.99, 0.0)


def usable_limit(x: str, none: float) -> Column:
    return F.when(F.abs(F.col(x) - none) > TOLERANCE, F.col(x))


def with_limits(panel: DataFrame, up: float = 1.5, down: float = 0.5) -> DataFrame:
    """Adds limit prices as multiples of the last known close."""
    before = F.last("close", ignorenulls=True).over(by_entity().rowsBetween(Window.unboundedPreceding, -1))
    return panel.withColumns({"up_limit": before * up, "down_limit": before * down})


def liquidity(bars: DataFrame, n: int = 20) -> DataFrame:
    """Mean and count of the amount over the last n observed bars; sessions
    without a bar take up no place here."""
    w = Window.partitionBy("entity").orderBy("session").rowsBetween(-(n - 1), 0)
    return bars.withColumns({"amount_mean": F.avg("amount").over(w), "amount_count": F.count("amount").over(w)})


def with_liquidity(panel: DataFrame, n: int = 20) -> DataFrame:
    """Adds liquidity() to the traded rows of a panel, which has the bars in it already."""
    w = Window.partitionBy("entity", "traded").orderBy("session").rowsBetween(-(n - 1), 0)
    own = lambda x: F.when(F.col("traded"), x.over(w))
    return panel.withColumns({"amount_mean": own(F.avg("amount")), "amount_count": own(F.count("amount"))})


def tradability(panel: DataFrame) -> DataFrame:
    """E5: whether the close stands at a limit, and what can be bought and sold."""
    up, down = usable_limit("up_limit", NO_LIMIT[0]), usable_limit("down_limit", NO_LIMIT[1])
    at_up = F.coalesce(F.col("traded") & (F.col("close") >= up - TOLERANCE), F.lit(False))
    at_down = F.coalesce(F.col("traded") & (F.col("close") <= down + TOLERANCE), F.lit(False))
    return panel.withColumns({"is_limit_up": at_up, "is_limit_down": at_down, "can_buy": F.col("traded") & ~at_up, "can_sell": F.col("traded") & ~at_down})


def first_reason(rules: Sequence[tuple[str, Column]]) -> Column:
    """The name of the first rule that holds, else null."""
    return F.coalesce(*[F.when(rule, F.lit(name)) for name, rule in rules])


def all_reasons(rules: Sequence[tuple[str, Column]]) -> Column:
    """The names of all rules that hold, in order, joined by semicolons."""
    return F.concat_ws(";", *[F.when(rule, F.lit(name)) for name, rule in rules])


def model_universe(panel: DataFrame, least_age: int, least_amount: float) -> DataFrame:
    """Model flags and their conjunction, of a panel with age, restricted,
    traded and amount_mean."""
    rules = [
        ("new", F.col("age") < least_age),
        ("restricted", F.col("restricted")),
        ("no_price", ~F.col("traded")),
        ("low_liquidity", F.coalesce(F.col("amount_mean") < least_amount, F.lit(True))),
    ]
    out = panel.withColumns({f"is_{name}": rule for name, rule in rules} | {"exclude_reason": all_reasons(rules)})
    return out.withColumn("in_model_universe", F.col("exclude_reason") == "")


def listing_flags(panel: DataFrame, listings: DataFrame, cal: DataFrame) -> DataFrame:
    """Adds list_date, delist_date, is_listed (from the one to the other, both included; never
    without a list date), list_age (sessions since the list date, 0 where not listed) and
    in_base_universe, from listings (entity, list_date, delist_date)."""
    rows = panel.join(listings.select("entity", "list_date", "delist_date"), "entity", "left")
    here = F.col("session")
    listed = F.col("list_date").isNotNull() & (here >= F.col("list_date")) & (F.col("delist_date").isNull() | (here <= F.col("delist_date")))
    aged = session_age(rows.withColumn("is_listed", listed), cal, "list_date")
    aged = aged.withColumn("list_age", F.when(F.col("is_listed"), F.col("age")).otherwise(0)).drop("age")
    return aged.withColumn("in_base_universe", F.col("is_listed"))


@dataclass(frozen=True)
class UniverseSettings:
    """What membership of the model universe asks for; None leaves a bound out."""

    least_age: int = 60
    least_amount: float = 0.0
    least_price: float | None = None
    full_window: int | None = None
    exclude_restricted: bool = True


def listed_universe(rows: DataFrame, settings: UniverseSettings) -> DataFrame:
    """Of rows with in_base_universe, list_age, restricted, suspended, traded, close,
    amount_mean and amount_count: the flags is_new, is_restricted, is_suspended, has_price and
    is_low_liquidity, all reasons to exclude a row, and in_model_universe."""
    no = lambda c: ~F.coalesce(c, F.lit(False))
    low = F.coalesce(F.col("amount_mean") < settings.least_amount, F.lit(True))
    if settings.full_window:
        low = low | F.coalesce(F.col("amount_count") < settings.full_window, F.lit(True))
    priced = F.coalesce(F.col("traded"), F.lit(False))
    if settings.least_price is not None:
        priced = priced & F.coalesce(F.col("close") >= settings.least_price, F.lit(False))
    base = F.col("in_base_universe")
    flags = {"is_new": base & (F.col("list_age") < settings.least_age), "is_restricted": F.coalesce("restricted", F.lit(False)), "is_suspended": F.coalesce("suspended", F.lit(False)), "has_price": priced, "is_low_liquidity": low}
    out = rows.withColumns(flags)
    # fixed values: the reasons as the universe table has them
    reasons = [
        ("not_listed", no(base)),
        ("new_stock", F.col("is_new")),
        ("st", F.col("is_restricted") & settings.exclude_restricted),
        ("suspended", F.col("is_suspended")),
        ("insufficient_price_data", ~F.col("has_price")),
        ("low_liquidity", F.col("is_low_liquidity")),
    ]
    out = out.withColumn("exclude_reason", all_reasons(reasons))
    return out.withColumn("in_model_universe", F.col("exclude_reason") == "")


#: The boards that a code's form tells.
BOARDS = (("bj_market", r"\.BJ$"), ("star_market", r"^688\d{3}\.SH$"), ("chinext_market", r"^300\d{3}\.SZ$"))


@dataclass(frozen=True)
class CandidateSettings:
    """What a candidate must have; None leaves a bound out."""

    least_list_days: int = 60
    least_market_value: float | None = None
    least_amount: float | None = None
    least_turnover: float | None = None
    most_turnover: float | None = None
    limit_tolerance: float = 0.01


def candidate_rules(settings: CandidateSettings) -> list[tuple[str, Column]]:
    """The rules of the cascade in their order, over rows with the flags of the
    universe, code, list_days, what was found for them (has_universe, has_daily,
    has_daily_basic, has_stk_limit), prices, amount, turnover_rate, total_mv and limits.
    A number that is missing fails its rule."""
    c = F.col
    no = lambda x: ~F.coalesce(x, F.lit(False))
    yes = lambda x: F.coalesce(x, F.lit(False))
    least = lambda x, bound: no(c(x) >= bound)
    ordered = (c("low") <= F.least("open", "close", "high")) & (c("high") >= F.greatest("open", "close", "low"))
    t = settings.limit_tolerance
    limits = (c("down_limit") > 0) & (c("up_limit") > c("down_limit")) & (c("close") > 0) & c("close").between(c("down_limit") - t, c("up_limit") + t)
    rules = [
        ("missing_universe", no(c("has_universe"))),
        ("not_in_model_universe", no(c("in_model_universe"))),
        *[(name, F.upper("code").rlike(form)) for name, form in BOARDS],
        ("st", yes(c("is_st"))),
        ("suspended", yes(c("is_suspended"))),
        ("insufficient_liquidity", yes(c("is_low_liquidity"))),
        ("newly_listed", least("list_days", settings.least_list_days)),
        ("missing_daily", no(c("has_daily"))),
        ("missing_daily_basic", no(c("has_daily_basic"))),
        ("missing_stk_limit", no(c("has_stk_limit"))),
        ("invalid_ohlc", no((F.least("open", "high", "low", "close") > 0) & ordered)),
    ]
    for name, x, bound in (("insufficient_market_cap", "total_mv", settings.least_market_value), ("insufficient_daily_amount", "amount", settings.least_amount), ("insufficient_turnover", "turnover_rate", settings.least_turnover)):
        if bound is not None:
            rules.append((name, least(x, bound)))
    if settings.most_turnover is not None:
        rules.append(("excessive_turnover", no(c("turnover_rate") <= settings.most_turnover)))
    return [*rules, ("abnormal_price_limits", no(limits))]


def filter_cascade(rows: DataFrame, rules: Sequence[tuple[str, Column]], score: str, n: int) -> DataFrame:
    """Adds the first failing rule, and for the rest rank and whether they miss
    the best n, as the reason below_candidate_cutoff."""
    marked = rows.withColumn("reason", first_reason(rules))
    order = Window.partitionBy("session", F.col("reason").isNull()).orderBy(F.col(score).desc_nulls_last(), "entity")
    marked = marked.withColumn("rank", F.when(F.col("reason").isNull(), F.row_number().over(order)))
    return marked.withColumn("reason", F.when(F.col("rank") > n, F.lit("below_candidate_cutoff")).otherwise(F.col("reason")))


def attach_entry_exit(panel: DataFrame, horizons: Sequence[int]) -> DataFrame:
    """A row for each session and horizon with the flags and opens of the
    entry (next) and exit session, looked up by lead in the panel's own order: the
    panel is dense, so that is the keyed join without a shuffle for each side."""
    e = by_entity()
    ahead = {f"entry_{c}": F.lead(c, 1).over(e) for c in ("session", "open", "traded", "in_base", "up_limit", "bench")}
    for h in horizons:
        ahead |= {f"exit_{c}_{h}": F.lead(c, 1 + h).over(e) for c in EXIT}
    wide = panel.withColumns(ahead)
    each = F.explode(F.array(*[F.struct(F.lit(h).alias("horizon"), *[F.col(f"exit_{c}_{h}").alias(f"exit_{c}") for c in EXIT]) for h in horizons]))
    return wide.select("entity", "session", "pos", *[f"entry_{c}" for c in ("session", "open", "traded", "in_base", "up_limit", "bench")], each.alias("x")).select("*", "x.*").drop("x")


def label_reasons() -> list[tuple[str, Column]]:
    """H2, H3: why a label is not available, the first that holds. Membership of the
    base universe is asked at the entry and at the exit session."""
    no = lambda c: ~F.coalesce(c, F.lit(False))
    return [
        # fixed values: the reasons as the label table has them
        ("insufficient_future_calendar", F.col("entry_session").isNull() | F.col("exit_session").isNull()),
        ("entry_not_in_base_universe", no(F.col("entry_in_base"))),
        ("missing_entry_price", no(F.col("entry_open") > 0)),
        ("missing_exit_price", no(F.col("exit_open") > 0)),
        ("entry_suspended", no(F.col("entry_traded"))),
        ("entry_not_buyable", F.coalesce(F.col("entry_open") >= F.col("entry_up_limit") - TOLERANCE, F.lit(False))),
        ("exit_not_in_base_universe", no(F.col("exit_in_base"))),
        ("exit_suspended", no(F.col("exit_traded"))),
        ("exit_not_sellable", F.coalesce(F.col("exit_open") <= F.col("exit_down_limit") + TOLERANCE, F.lit(False))),
        ("missing_benchmark_price", no(F.col("entry_bench") > 0) | no(F.col("exit_bench") > 0)),
    ]


def forward_labels(panel: DataFrame, horizons: Sequence[int], quantiles: int = 5, parts: int | None = None) -> DataFrame:
    """H1 to H5, H7: labels of a panel with limits, bench and in_base: availability,
    forward, benchmark and excess return, and the excess return's percentile and
    quantile among the available rows of a session and horizon. parts is into how many
    parts sessions are dealt for the percentiles; without it Spark's setting holds, at any size."""
    rows = attach_entry_exit(panel, horizons).withColumn("reason", first_reason(label_reasons()))
    ok = F.col("reason").isNull()
    rows = rows.withColumns({"is_label_available": ok, "forward_ret": F.when(ok, safe_div("exit_open", "entry_open") - 1), "benchmark_forward_ret": F.when(ok, safe_div("exit_bench", "entry_bench") - 1)})
    rows = rows.withColumn("future_excess_ret", F.col("forward_ret") - F.col("benchmark_forward_ret"))
    rows = rows.repartition(parts, "session", "horizon") if parts else rows
    rows = rows.withColumn("label_pct", avg_rank_pct("future_excess_ret", ["session", "horizon"]))
    return rows.withColumn("label_quantile", bucketize("label_pct", quantiles, "floor"))


def delayed_exit(panel: DataFrame, horizon: int, most: int) -> DataFrame:
    """H6: the first session from the planned exit to `most` later on which the
    entity could be sold, else null."""
    first = 1 + horizon
    ahead = by_entity().rowsBetween(first, first + most)
    return panel.withColumn("exit_pos", F.min(F.when(F.col("can_sell"), F.col("pos"))).over(ahead))


def label_availability(labels: DataFrame, periods: Mapping[str, tuple[str, str]]) -> DataFrame:
    """H8: for each horizon and period the rows, the available ones, and the first
    and last session with any."""
    named = {}
    for p, (lo, hi) in periods.items():
        inside = F.col("session").between(F.to_date(F.lit(lo)), F.to_date(F.lit(hi)))
        named |= {f"{p}_rows": F.count_if(inside), f"{p}_available": F.count_if(inside & F.col("is_label_available")), f"{p}_first": F.min(F.when(inside & F.col("is_label_available"), F.col("session"))), f"{p}_last": F.max(F.when(inside & F.col("is_label_available"), F.col("session")))}
    return labels.groupBy("horizon").agg(*[c.alias(n) for n, c in named.items()])


def reconcile_counts(labels: DataFrame, universe: DataFrame, horizons: Sequence[int]) -> DataFrame:
    """H9: the (session, horizon) whose number of labels is not that of the base
    universe."""
    want = universe.where("in_base").groupBy("session").agg(F.count(F.lit(1)).alias("expected")).withColumn("horizon", F.explode(F.array(*[F.lit(h) for h in horizons])))
    have = labels.groupBy("session", "horizon").agg(F.count(F.lit(1)).alias("found"))
    both = want.join(have, ["session", "horizon"], "left").withColumn("found", F.coalesce("found", F.lit(0)))
    return both.where("found <> expected")


def label_audit(picked: DataFrame, labels: DataFrame) -> DataFrame:
    """Of picked (entity, session): how many have a label, how many an available
    one, and how many whose dates are out of order."""
    both = picked.join(labels.withColumn("_m", F.lit(1)), ["entity", "session"], "left")
    bad = (F.col("entry_session") <= F.col("session")) | (F.col("exit_session") <= F.col("entry_session"))
    return both.agg(F.count(F.lit(1)).alias("n"), F.count("_m").alias("matched"), F.avg(F.coalesce(F.col("is_label_available"), F.lit(False)).cast("double")).alias("available_ratio"), F.count_if(F.coalesce(bad, F.lit(False))).alias("violations"))


def latest_only_flag(panel: DataFrame, restricted_now: DataFrame, name: str = "restricted") -> DataFrame:
    """Without a history of restrictions, today's list holds for the last session
    alone; on all others nothing is known to be restricted."""
    last = panel.agg(F.max("session").alias("_last"))
    both = panel.crossJoin(F.broadcast(last)).join(restricted_now.select("entity").distinct().withColumn("_now", F.lit(True)), "entity", "left")
    return both.withColumn(name, F.coalesce(F.col("_now"), F.lit(False)) & (F.col("session") == F.col("_last"))).drop("_now", "_last")


def fundamental_ratios(reports: DataFrame, ratios: Mapping[str, tuple[str, str]], changes: Sequence[str], order: str = "available") -> DataFrame:
    """ratios of reported values, and their change against the entity's previous
    announcement."""
    w = Window.partitionBy("entity").orderBy(order)
    out = reports.withColumns({n: safe_div(a, b) for n, (a, b) in ratios.items()})
    return out.withColumns({f"{c}_change": F.col(c) - F.lag(c).over(w) for c in changes})
