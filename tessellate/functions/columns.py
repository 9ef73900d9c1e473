"""Column helpers from which the panel operators are put together."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

ENTITY, SESSION, POS = "entity", "session", "pos"
#: The share of a window's places that must hold a value.
MIN_FILLED = 0.6


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def by_entity(entity: str = ENTITY, order: str = POS) -> WindowSpec:
    return Window.partitionBy(entity).orderBy(order)


def last_rows(w: int, entity: str = ENTITY, order: str = POS) -> WindowSpec:
    """The present and the w - 1 rows before it, of one entity."""
    return by_entity(entity, order).rowsBetween(-(w - 1), 0)


def safe_div(a: Column | str, b: Column | str) -> Column:
    """a / b, null where b is zero."""
    b = col(b)
    return F.when(b != 0, col(a) / b)


def gated(agg: Callable[[Column], Column], x: Column | str, w: int, frac: float = MIN_FILLED, over: WindowSpec | None = None) -> Column:
    """agg(x) over the last w rows, null unless at least ceil(w * frac) hold a value."""
    over = over or last_rows(w)
    return F.when(F.count(col(x)).over(over) >= math.ceil(w * frac), agg(col(x)).over(over))


def finite(x: Column | str) -> Column:
    """x, with NaN and infinities null."""
    x = col(x)
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def safe_log(x: Column | str) -> Column:
    return F.when(col(x) > 0, F.ln(col(x)))


def inverse(x: Column | str) -> Column:
    return F.when(col(x) > 0, 1 / col(x))


def avg_rank(x: Column | str, by: Sequence[str], ascending: bool = True) -> Column:
    """The rank of x among the non-null values of its group, ties averaged."""
    x = col(x)
    order = x.asc_nulls_last() if ascending else x.desc_nulls_last()
    first = F.rank().over(Window.partitionBy(*by).orderBy(order))
    ties = F.count(F.lit(1)).over(Window.partitionBy(*by, x))
    return F.when(x.isNotNull(), first + (ties - 1) / 2.0)


def avg_rank_pct(x: Column | str, by: Sequence[str], eligible: Column | None = None) -> Column:
    """avg_rank over the group's size; rows that are not eligible get null and
    don't count."""
    x = col(x) if eligible is None else F.when(eligible, col(x))
    return avg_rank(x, by) / F.count(x).over(Window.partitionBy(*by))


BUCKET_RULES = ("floor", "floor_open", "ceil", "decile")


def bucketize(p: Column | str, n: int, rule: str = "floor") -> Column:
    """A bucket from a percentile p in (0, 1].

    floor: floor((p - 1e-12) n), 0 to n - 1. floor_open: floor((p - eps) n), n - 1
    at most. ceil: ceil(p n) - 1, 0 to n - 1. decile: ceil(p n) of p clipped to
    [0, 1], 1 to n. Equal values share a bucket, which ntile would split."""
    p = col(p)
    if rule == "floor":
        return F.when(p.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(n - 1), F.floor((p - 1e-12) * n)))).cast("int")
    if rule == "floor_open":
        return F.least(F.lit(n - 1), F.floor((p - 2.220446049250313e-16) * n)).cast("int")
    if rule == "ceil":
        return F.when(p.isNotNull(), F.greatest(F.lit(0), F.least(F.lit(n - 1), F.ceil(p * n) - 1))).cast("int")
    if rule == "decile":
        clipped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), p))
        return F.when(p.isNotNull(), F.greatest(F.lit(1), F.least(F.lit(n), F.ceil(clipped * n)))).cast("int")
    raise ValueError(f"rule must be one of {BUCKET_RULES}")


def corr_of(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation of a group by moments, null where either is constant."""
    x, y = col(x), col(y)
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    sd = F.stddev_pop(x) * F.stddev_pop(y)
    return F.when(sd > 1e-14, (F.avg(x * y) - F.avg(x) * F.avg(y)) / sd)


def place_in(edges: Column | str, x: Column | str, most: int) -> Column:
    """How many of the edges, an ascending array of at most `most`, are at or below x:
    by looking at all of a few, by halving among many."""
    edges, x = col(edges), col(x)
    if most <= 64:
        return F.size(F.filter(edges, lambda e: e <= x))
    middle = lambda a: F.floor((a["lo"] + a["hi"]) / 2).cast("int")
    step = lambda a, _: F.when(a["lo"] >= a["hi"], a).otherwise(
        F.when(F.get(edges, middle(a)) <= x, F.struct((middle(a) + 1).alias("lo"), a["hi"].alias("hi"))).otherwise(F.struct(a["lo"].alias("lo"), middle(a).alias("hi")))
    )
    return F.aggregate(F.sequence(F.lit(1), F.lit(max(1, most).bit_length())), F.struct(F.lit(0).alias("lo"), F.size(edges).alias("hi")), step)["lo"]
