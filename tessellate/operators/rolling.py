"""Rolling features of a dense panel (entity, pos, open, high, low, close, vol, amount,
traded, bench). Windows count sessions; a missing session takes up its place.

All windows share a partitioning and an order, so a set of features is one shuffle
and one sort. No frame holds w rows: sums are differences of running ones, and extremes
come by doubling, so the length of a window costs nothing."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import by_entity, inverse, safe_div, safe_log
from ..functions.running import Rolling, extremes_of

RETURN_WINDOWS, SHORT_WINDOWS, MEDIUM_WINDOWS, LONG_WINDOWS = (1, 3, 5, 10, 20, 60, 120), (1, 2, 3, 5), (5, 10, 20, 60), (20, 60, 120)


def _lag(x: str, n: int = 1) -> Column:
    return F.lag(x, n).over(by_entity())


def with_returns(panel: DataFrame) -> DataFrame:
    """ret_1d, null unless this and the previous session were traded; and the
    benchmark's return on its last known level."""
    known = F.last("bench", ignorenulls=True).over(by_entity().rowsBetween(Window.unboundedPreceding, -1))
    return panel.withColumns(
        {
            "ret_1d": F.when(F.col("traded") & _lag("traded"), safe_div("close", _lag("close")) - 1),
            "bench_ret": safe_div("bench", known) - 1,
        }
    )


def candle(panel: DataFrame) -> DataFrame:
    """intraday return, body, shadows and the close's place in the range."""
    span = F.col("high") - F.col("low")
    return panel.withColumns(
        {
            "intraday_ret": safe_div("close", "open") - 1,
            "candle_body": safe_div(F.abs(F.col("close") - F.col("open")), span),
            "upper_shadow": safe_div(F.col("high") - F.greatest("open", "close"), span),
            "lower_shadow": safe_div(F.least("open", "close") - F.col("low"), span),
            "close_location": safe_div(F.col("close") - F.col("low"), span),
        }
    )


@dataclass(frozen=True)
class Group:
    """Features that are made alike: the columns they need beforehand, by lags (`before`), the values that are summed,
    which of them have variances and covariances, and the features of a window."""

    values: Callable[[DataFrame], dict[str, Column]]
    features: Callable[[Rolling, Sequence[str], int], dict[str, Column]]
    before: Callable[[Sequence[int]], dict[str, Column]] = lambda windows: {}
    spread: tuple[str, ...] = ()
    pairs: tuple[tuple[str, str], ...] = ()
    helpers: tuple[str, ...] = ()


def rolled(panel: DataFrame, windows: Sequence[int], groups: Sequence[Group]) -> DataFrame:
    """The features of groups over all windows, from one set of running sums."""
    before: dict[str, Column] = {}
    for g in groups:
        before |= g.before(windows)
    out = panel.withColumns(before) if before else panel
    values: dict[str, Column] = {}
    for g in groups:
        values |= g.values(out)
    spread = [k for g in groups for k in g.spread]
    r = Rolling(out, values, windows, dict.fromkeys(spread), dict.fromkeys(p for g in groups for p in g.pairs))
    made: dict[str, Column] = {}
    for g in groups:
        for w in windows:
            made |= g.features(r, out.columns, w)
    helpers = [h for g in groups for h in g.helpers] + [c for c in before if c.startswith("_")]
    return r.finish(made).drop(*helpers)


_GAPS = Group(
    before=lambda ws: {"gap_open_ret": safe_div("open", _lag("close")) - 1},
    values=lambda df: {"gap_open_ret": F.col("gap_open_ret")},
    features=lambda r, _, w: {"gap_abs": F.abs("gap_open_ret"), f"gap_mean_{w}": r.mean("gap_open_ret", w, 0.0)},
)


def gaps(panel: DataFrame, windows: Sequence[int]) -> DataFrame:
    """the opening gap against the previous close, its size and rolling mean,
    for which one value is enough."""
    return rolled(panel, windows, [_GAPS])


def _compounded(r: Rolling, _: Sequence[str], w: int) -> dict[str, Column]:
    own, bench = r.total("log_ret", w), r.total("log_bench", w)
    ret = F.exp(own) - 1
    return {f"logret_sum_{w}": own, f"ret_{w}": ret, f"market_excess_ret_{w}": ret - (F.exp(bench) - 1), f"reversal_ret_{w}": -ret}


_COMPOUNDED = Group(values=lambda df: {"log_ret": safe_log(1 + F.col("ret_1d")), "log_bench": safe_log(1 + F.col("bench_ret"))}, features=_compounded)


def compounded(panel: DataFrame, windows: Sequence[int]) -> DataFrame:
    """log return sums, compounded returns, those above the
    benchmark's, and reversals, from ret_1d and bench_ret."""
    return rolled(panel, windows, [_COMPOUNDED])


def _trend(r: Rolling, _: Sequence[str], w: int) -> dict[str, Column]:
    mean, sd = r.mean("close", w), r.deviation("close", w)
    return {f"ma_ratio_{w}": safe_div("close", mean), f"ma_z_{w}": F.when(sd > 1e-9, (F.col("close") - mean) / sd), f"trend_slope_{w}": safe_div(mean, f"_lag_{w}") - 1}


_TREND = Group(before=lambda ws: {f"_lag_{w}": _lag("close", w) for w in ws}, values=lambda df: {"close": F.col("close")}, spread=("close",), features=_trend)


def trend(panel: DataFrame, windows: Sequence[int]) -> DataFrame:
    """close over its mean, its z-score, and the mean over the close w back."""
    return rolled(panel, windows, [_TREND])


def _dispersion(r: Rolling, _: Sequence[str], w: int) -> dict[str, Column]:
    below = r.mean("below", w)
    below = F.when(below < 0, 0.0).otherwise(below)  # a difference of sums
    return {f"positive_ret_ratio_{w}": r.mean("rising", w), f"realized_vol_{w}": r.deviation("ret_1d", w), f"downside_vol_{w}": F.sqrt(below)}


def _dispersed(minimum_return: float) -> Group:
    def values(_: DataFrame) -> dict[str, Column]:
        there = F.col("ret_1d").isNotNull()
        below = F.pow(F.least(F.col("ret_1d") - minimum_return, F.lit(0.0)), F.lit(2.0))
        return {"rising": F.when(there, (F.col("ret_1d") > 0).cast("double")), "below": F.when(there, below), "ret_1d": F.col("ret_1d")}

    return Group(values=values, spread=("ret_1d",), features=_dispersion)


def dispersion(panel: DataFrame, windows: Sequence[int], minimum_return: float = 0.0) -> DataFrame:
    """Share of gains, volatility and downside volatility of ret_1d."""
    return rolled(panel, windows, [_dispersed(minimum_return)])


def _activity(r: Rolling, columns: Sequence[str], w: int) -> dict[str, Column]:
    amount = r.mean("amount", w)
    out = {f"volume_ratio_{w}": safe_div("vol", r.mean("vol", w)), f"amount_ratio_{w}": safe_div("amount", amount), f"amount_cv_{w}": safe_div(r.deviation("amount", w), amount), f"amihud_{w}": r.mean("amihud", w), "amihud": safe_div(F.abs("ret_1d"), "amount")}
    return out | ({f"turnover_ratio_{w}": safe_div("turnover_rate", r.mean("turnover_rate", w))} if "turnover_rate" in columns else {})


def _active(df: DataFrame) -> dict[str, Column]:
    own = {"vol": F.col("vol").cast("double"), "amount": F.col("amount").cast("double"), "amihud": safe_div(F.abs("ret_1d"), "amount")}
    return own | ({"turnover_rate": F.col("turnover_rate")} if "turnover_rate" in df.columns else {})


_ACTIVITY = Group(values=_active, spread=("amount",), features=_activity)


def activity(panel: DataFrame, windows: Sequence[int]) -> DataFrame:
    """volume, amount and turnover rate (where there is one) over their means, the amount's coefficient of
    variation, and illiquidity (absolute return per amount)."""
    return rolled(panel, windows, [_ACTIVITY])


def extremes(panel: DataFrame, windows: Sequence[int]) -> DataFrame:
    """distance to the high and low of a window, place in its range,
    drawdown, and the worst drawdown within the window. Windows come by doubling."""
    ws, c = list(windows), F.col
    out = extremes_of(panel, [("_hi", c("high"), True, ws), ("_lo", c("low"), False, ws), ("_top", c("close"), True, ws)])
    r = Rolling(out, {k: c(k).cast("double") for k in ("high", "low", "close")}, ws)
    made, falls = {}, {}
    for w in ws:
        hi, lo, top = r.enough("high", w, c(f"_hi_{w}")), r.enough("low", w, c(f"_lo_{w}")), r.enough("close", w, c(f"_top_{w}"))
        made |= {f"dist_high_{w}": safe_div("close", hi) - 1, f"dist_low_{w}": safe_div("close", lo) - 1, f"range_pos_{w}": safe_div(c("close") - lo, hi - lo), f"drawdown_{w}": safe_div("close", top) - 1}
        falls[f"drawdown_{w}"] = [w]
    out = r.finish(made).drop(*[f"{k}_{w}" for k in ("_hi", "_lo", "_top") for w in ws])
    out = extremes_of(out, [(f"_worst_{w}", c(f"drawdown_{w}"), False, [w]) for w in ws])
    r = Rolling(out, {k: c(k) for k in falls}, falls)
    out = r.finish({f"max_drawdown_{w}": r.enough(f"drawdown_{w}", w, c(f"_worst_{w}_{w}")) for w in ws})
    return out.drop(*[f"_worst_{w}_{w}" for w in ws])


def _comovement(r: Rolling, _: Sequence[str], w: int) -> dict[str, Column]:
    over = lambda x: F.when(x > 1e-12, x)
    corr = r.covariance("ret_1d", "vol_chg", w) / (over(r.deviation("ret_1d", w)) * over(r.deviation("vol_chg", w)))
    return {f"ret_vol_corr_{w}": corr, f"beta_{w}": r.covariance("ret_1d", "bench_ret", w) / over(r.variance("bench_ret", w))}


_COMOVEMENT = Group(
    before=lambda ws: {"vol_chg": safe_div("vol", _lag("vol")) - 1},
    values=lambda df: {k: F.col(k) for k in ("ret_1d", "vol_chg", "bench_ret")},
    spread=("ret_1d", "vol_chg", "bench_ret"),
    pairs=(("ret_1d", "vol_chg"), ("ret_1d", "bench_ret")),
    features=_comovement,
)


def residual_volatility(frame: DataFrame, windows: Sequence[int]) -> DataFrame:
    """the volatility of what a window's beta leaves of its returns."""
    left = {f"left_{w}": F.col("ret_1d") - F.col(f"beta_{w}") * F.col("bench_ret") for w in windows}
    r = Rolling(frame, left, {f"left_{w}": [w] for w in windows}, spread=list(left))
    return r.finish({f"residual_vol_{w}": r.deviation(f"left_{w}", w) for w in windows})


def comovement(panel: DataFrame, windows: Sequence[int]) -> DataFrame:
    """Correlation of returns with volume changes, beta to the
    benchmark, and the volatility of what beta leaves."""
    return residual_volatility(rolled(panel, windows, [_COMOVEMENT]), windows)


#: The groups that one set of running sums serves.
GROUPS = (_GAPS, _COMPOUNDED, _TREND, _dispersed(0.0), _ACTIVITY, _COMOVEMENT)


def valuation(df: DataFrame, ratios: Sequence[str], sizes: Sequence[str]) -> DataFrame:
    """inverses of positive ratios, logs of positive sizes."""
    return df.withColumns({f"{c}_inv": inverse(c) for c in ratios} | {f"{c}_log": safe_log(c) for c in sizes})


def missing_ratios(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, missing_ratio), in one pass."""
    one = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in features])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("missing_ratio")) for c in features])).alias("x")).select("x.*")


#: How long before the first session wanted the windows begin to warm up.
WARM_UP_DAYS = 550


def warm_up_start(start: str, days: int = WARM_UP_DAYS) -> str:
    """the date from which history is read for features from start on."""
    return (date.fromisoformat(start) - timedelta(days=days)).isoformat()


def feature_frame(panel: DataFrame, windows: Sequence[int], start: str | None = None, end: str | None = None) -> DataFrame:
    """all market features over windows. History from warm_up_start on warms
    the windows up; only the sessions from start to end are returned. The bound on what
    is read stands below the windows, so it goes down to the scan."""
    if start:
        panel = panel.where(F.col("session") >= F.to_date(F.lit(warm_up_start(start))))
    if end:
        panel = panel.where(F.col("session") <= F.to_date(F.lit(end)))
    out = rolled(candle(with_returns(panel)), windows, GROUPS)
    out = extremes(residual_volatility(out, windows), windows)
    return out.where(F.col("session") >= F.to_date(F.lit(start))) if start else out


def registered(frame: DataFrame, names: Sequence[str], key: Sequence[str] = ("entity", "session")) -> DataFrame:
    """the columns of a feature table in the registry's order; a feature that the
    frame lacks is null."""
    have = set(frame.columns)
    return frame.select(*key, *[F.col(n) if n in have else F.lit(None).cast("double").alias(n) for n in names])
