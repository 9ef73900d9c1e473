"""Features of announced reports, as they were known on each session."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import safe_div
from .joins import as_of, later_ratio
from .panel import keep_last

#: The ratios of announced values, and the values whose change from report to report is a feature.
RATIOS = {"debt_to_assets": ("total_liab", "total_assets"), "current_ratio": ("total_cur_assets", "total_cur_liab")}
CHANGES = ("roe", "revenue_yoy", "netprofit_yoy")
FEATURES = ("roe", "roa", "grossprofit_margin", "netprofit_margin", "debt_to_assets", "current_ratio", "ocf_to_profit", "revenue_yoy", "netprofit_yoy", "roe_delta", "revenue_yoy_delta", "netprofit_yoy_delta")


def announced(reports: DataFrame, changes: Sequence[str] = (), order: Sequence[str] = ("revision",)) -> DataFrame:
    """Reports (entity, period, announced, final, ...) with `available`, the final announcement's
    date or else the first one's; of rows with one entity, period and date the last by order stays.
    changes are taken from the entity's report before, by availability and period: <name>_delta."""
    dated = reports.withColumn("available", F.coalesce("final", "announced")).where("available IS NOT NULL")
    one = keep_last(dated, ["entity", "period", "available"], list(order))
    w = Window.partitionBy("entity").orderBy("available", "period")
    return one.withColumns({f"{c}_delta": F.col(c) - F.lag(c).over(w) for c in changes}) if changes else one


def cash_to_profit(income: DataFrame, cash: DataFrame, profit: str = "n_income", flow: str = "n_cashflow_act") -> DataFrame:
    """The cash flow over the profit of a period, from the last announcement of each, available
    when both are: entity, period, available, ocf_to_profit."""
    last = lambda df, c: keep_last(df.select("entity", "period", "available", c), ["entity", "period"], ["available"])
    return later_ratio(last(cash, flow), last(income, profit), ["entity", "period"], flow, profit, "ocf_to_profit")


def fundamental_features(base: DataFrame, tables: Mapping[str, DataFrame], features: Sequence[str] = FEATURES) -> DataFrame:
    """entity, session and the features of each row of base, as of its session: from each of
    the announced tables (entity, period, available and values) the last row available by then, the
    latest period of one date; ratios of these; null where a table or value is lacking.

    Every table takes one as-of pass over the base in the order of the entity, so no report meets
    a session that it doesn't serve."""
    out = base.select("entity", "session")
    for table in tables.values():
        values = [c for c in table.columns if c not in ("entity", "period", "available", "announced", "final", "revision")]
        out = as_of(out, table, "entity", "session", "available", values, ["period"])
    have = set(out.columns)
    out = out.withColumns({n: safe_div(a, b) for n, (a, b) in RATIOS.items() if {a, b} <= have})
    have = set(out.columns)
    return out.select("entity", "session", *[F.col(f) if f in have else F.lit(None).cast("double").alias(f) for f in features])
