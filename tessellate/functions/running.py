"""Aggregates of the last w rows of an entity, without frames of w rows.

Sums, means, deviations and covariances are differences of running sums: one frame from
an entity's first row on serves every w, and `lag(w)` gives what to take away. Greatest and
least values come by doubling: those of 2 k rows are those of k rows and of the k rows
before, and a window is covered by two overlapping ones of a power of two. Everything
shares one partitioning and one sort."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import ENTITY, MIN_FILLED, POS, by_entity, finite


class Rolling:
    """df with running sums of values, from which windows are taken.

    Values that aren't finite count as missing. Those of `spread` have variances, those
    of `pairs` covariances; both are summed as distances from the entity's first value, so
    that little cancels out and later rows change nothing. The variance of a window whose
    values are all equal is exactly 0; otherwise its error is about 1e-16 of the running
    sum of squared distances.

    windows holds the w's, or those of each value by name."""

    def __init__(self, df: DataFrame, values: Mapping[str, Column], windows: Sequence[int] | Mapping[str, Sequence[int]], spread: Sequence[str] = (), pairs: Sequence[tuple[str, str]] = (), entity: str = ENTITY, order: str = POS):
        self.spread, self.pairs = set(spread), list(pairs)
        own = lambda k: list(windows[k] if isinstance(windows, Mapping) else windows)
        centred = self.spread | {k for p in self.pairs for k in p}
        by, c = by_entity(entity, order), F.col
        run = by.rowsBetween(Window.unboundedPreceding, 0)
        keep = list(df.columns)
        df = df.withColumns({f"_v_{k}": finite(v) for k, v in values.items()})
        if centred:
            before = by.rowsBetween(Window.unboundedPreceding, -1)
            first = {f"_m_{k}": F.first(f"_v_{k}", ignorenulls=True).over(run) for k in values if k in centred}
            df = df.withColumns(first | {f"_p_{k}": F.last(f"_v_{k}", ignorenulls=True).over(before) for k in values if k in self.spread})
        at = {k: c(f"_v_{k}") - c(f"_m_{k}") if k in centred else c(f"_v_{k}") for k in values}
        sums = {f"n_{k}": c(f"_v_{k}").isNotNull().cast("long") for k in values} | {f"s_{k}": at[k] for k in values}
        sums |= {f"q_{k}": at[k] * at[k] for k in values if k in self.spread}
        for x, y in self.pairs:
            there = at[x].isNotNull() & at[y].isNotNull()
            sums |= {f"n_{x}_{y}": there.cast("long"), f"s_{x}_{y}": at[x] * at[y], f"x_{x}_{y}": F.when(there, at[x]), f"y_{x}_{y}": F.when(there, at[y])}
        wanted = {name: own(k) for k in values for name in (f"n_{k}", f"s_{k}", f"q_{k}") if name in sums}
        wanted |= {f"{a}_{x}_{y}": own(x) for x, y in self.pairs for a in "nsxy"}
        df = df.withColumns({f"_r_{k}": F.coalesce(F.sum(v).over(run), F.lit(0)) for k, v in sums.items()})
        # where a value last changed, as the number of values up to there
        changed = {f"_c_{k}": F.last(F.when(c(f"_v_{k}").isNotNull() & ~c(f"_v_{k}").eqNullSafe(c(f"_p_{k}")), c(f"_r_n_{k}")), ignorenulls=True).over(run) for k in values if k in self.spread}
        lags = {f"_l_{k}_{w}": F.coalesce(F.lag(f"_r_{k}", w).over(by), F.lit(0)) for k, ws in wanted.items() for w in ws}
        self.frame, self._keep = df.withColumns(lags | changed), keep

    def _over(self, k: str, w: int) -> Column:
        return F.col(f"_r_{k}") - F.col(f"_l_{k}_{w}")

    def count(self, k: str, w: int) -> Column:
        return self._over(f"n_{k}", w)

    def enough(self, k: str, w: int, x: Column, frac: float = MIN_FILLED) -> Column:
        """x, null unless at least ceil(w * frac) of the last w rows hold a value of k."""
        return F.when(self.count(k, w) >= max(1, math.ceil(w * frac)), x)

    def _from_centre(self, k: str, w: int) -> Column:
        return self._over(f"s_{k}", w) / self.count(k, w)

    def _centre(self, k: str) -> Column:
        return F.col(f"_m_{k}") if f"_m_{k}" in self.frame.columns else F.lit(0.0)

    def mean(self, k: str, w: int, frac: float = MIN_FILLED) -> Column:
        return self.enough(k, w, self._from_centre(k, w) + self._centre(k), frac)

    def total(self, k: str, w: int, frac: float = MIN_FILLED) -> Column:
        return self.enough(k, w, self._over(f"s_{k}", w) + self.count(k, w) * self._centre(k), frac)

    def variance(self, k: str, w: int, frac: float = MIN_FILLED) -> Column:
        """The sample variance, null of fewer than two values."""
        n = self.count(k, w)
        raw = (self._over(f"q_{k}", w) - self._over(f"s_{k}", w) * self._from_centre(k, w)) / (n - 1)
        constant = F.col(f"_c_{k}") - 1 <= F.col(f"_l_n_{k}_{w}")
        return self.enough(k, w, F.when(n > 1, F.when(constant, F.lit(0.0)).otherwise(F.greatest(raw, F.lit(0.0)))), frac)

    def deviation(self, k: str, w: int, frac: float = MIN_FILLED) -> Column:
        return F.sqrt(self.variance(k, w, frac))

    def covariance(self, x: str, y: str, w: int, frac: float = MIN_FILLED) -> Column:
        """(E[xy] - E[x] E[y]) n / (n - 1), where each mean is over its own values and n
        counts the pairs; this differs from covar_samp where one side is missing."""
        p = f"{x}_{y}"
        n = self._over(f"n_{p}", w)
        mean = lambda a: self._over(f"{a}_{p}", w) / n
        a, b = self._from_centre(x, w), self._from_centre(y, w)
        # the products of values are those of distances and means; these differ where a side is missing
        raw = mean("s") - a * b + F.col(f"_m_{x}") * (mean("y") - b) + F.col(f"_m_{y}") * (mean("x") - a)
        return F.when((n >= math.ceil(w * frac)) & (n > 1), raw * n / (n - 1))

    def finish(self, columns: Mapping[str, Column]) -> DataFrame:
        """The frame with columns made of windows, without the sums."""
        names = [k for k in self._keep if k not in columns]
        return self.frame.select(*[F.col(f"`{k}`") for k in names], *[v.alias(k) for k, v in columns.items()])


def extremes_of(df: DataFrame, wanted: Sequence[tuple[str, Column, bool, Sequence[int]]], entity: str = ENTITY, order: str = POS) -> DataFrame:
    """For each (name, value, whether greatest, windows) the columns name_w: the greatest
    or least value of the last w rows, missing ones left out."""
    by = by_entity(entity, order)
    best: dict[str, Callable] = {name: F.greatest if top else F.least for name, _, top, _ in wanted}
    level = {name: f"_x_{name}_0" for name, _, _, _ in wanted}
    df = df.withColumns({level[name]: v for name, v, _, _ in wanted})
    helpers, size, k = list(level.values()), 1, 0
    reach = {name: max(ws) for name, _, _, ws in wanted}
    out: dict[str, Column] = {}
    while True:
        for name, _, _, ws in wanted:
            for w in ws:
                if size <= w < 2 * size:
                    x = F.col(level[name])
                    out[f"{name}_{w}"] = x if w == size else best[name](x, F.lag(level[name], w - size).over(by))
        grown = [name for name in level if reach[name] >= 2 * size]
        if not grown:
            break
        k += 1
        df = df.withColumns({f"_x_{name}_{k}": best[name](F.col(level[name]), F.lag(level[name], size).over(by)) for name in grown})
        level |= {name: f"_x_{name}_{k}" for name in grown}
        helpers += [level[name] for name in grown]
        size *= 2
    return df.withColumns(out).drop(*helpers)
