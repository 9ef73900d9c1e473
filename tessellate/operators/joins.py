"""Point-in-time and keyed joins of panel tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import safe_div
from .panel import keep_last


def as_of(left: DataFrame, right: DataFrame, key: str, left_date: str, right_date: str, values: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """To each row of left the values of the right row of its key with the latest
    date at or before its own; whole rows, so that nulls in it stay. Both sides are
    put in one order and each left row looks back to the last right row: a sort, and
    no pairs. Ties on the right go to the greatest tie columns."""
    pick = F.struct(*values)
    a = left.withColumns({"_d": F.col(left_date).cast("timestamp"), "_side": F.lit(1), "_v": F.lit(None).cast(right.select(pick.alias("v")).schema["v"].dataType), "_k": F.col(key), "_left": F.struct(*left.columns)}).select("_k", "_d", "_side", "_v", "_left", F.lit(None).cast(right.select(F.struct(F.lit(1), *tie).alias("t")).schema["t"].dataType).alias("_t"))
    b = right.select(F.col(key).alias("_k"), F.col(right_date).cast("timestamp").alias("_d"), F.lit(0).alias("_side"), pick.alias("_v"), F.lit(None).cast(a.schema["_left"].dataType).alias("_left"), F.struct(F.lit(1), *tie).alias("_t"))
    spec = Window.partitionBy("_k").orderBy("_d", "_side", "_t").rowsBetween(Window.unboundedPreceding, 0)
    found = a.unionByName(b).withColumn("_v", F.last("_v", ignorenulls=True).over(spec)).where("_side = 1")
    return found.select("_left.*", *[F.col(f"_v.{c}").alias(c) for c in values])


def available(reports: DataFrame, entity: str, announced: str, final: str, order: Sequence[str]) -> DataFrame:
    """D3: adds `available`, the final announcement's date or else the first one's,
    and keeps the last revision of each entity and date."""
    dated = reports.withColumn("available", F.coalesce(final, announced))
    return keep_last(dated.where("available IS NOT NULL"), [entity, "available"], order)


def later_ratio(a: DataFrame, b: DataFrame, key: Sequence[str], x: str, y: str, out: str) -> DataFrame:
    """X / y of two tables matched on key, available when both are."""
    both = a.select(*key, x, F.col("available").alias("_a")).join(b.select(*key, y, F.col("available").alias("_b")), list(key))
    return both.select(*key, F.greatest("_a", "_b").alias("available"), safe_div(x, y).alias(out))


def merged_intervals(spans: DataFrame, cal: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """(key, _lo, _hi): the positions of the first and last session within intervals; those
    that overlap or touch are one. An open end reaches to the calendar's."""
    w = Window.orderBy("session")
    here = F.col("session")
    near = cal.withColumns({"_after": F.coalesce(F.date_add(F.lag("session").over(w), 1), here), "_until": F.coalesce(F.date_sub(F.lead("session").over(w), 1), here)})
    ends = cal.agg(F.min("session").alias("_first"), F.max("session").alias("_last"))
    up = near.select(F.explode(F.sequence("_after", here)).alias("_s"), F.col("pos").alias("_lo"))
    down = near.select(F.explode(F.sequence(here, "_until")).alias("_e"), F.col("pos").alias("_hi"))
    rows = spans.crossJoin(F.broadcast(ends)).withColumns({"_s": F.greatest(F.col(start), F.col("_first")), "_e": F.least(F.coalesce(end, "_last"), F.col("_last"))}).where("_s <= _e")
    placed = rows.join(F.broadcast(up), "_s").join(F.broadcast(down), "_e").where("_lo <= _hi")
    # intervals that overlap or touch are one, so that no session is made twice
    one = placed.groupBy(key, "_lo").agg(F.max("_hi").alias("_hi"))
    w = Window.partitionBy(key).orderBy("_lo")
    before = F.max("_hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    begun = one.withColumn("_new", F.when(F.col("_lo") <= before + 1, 0).otherwise(1))
    islands = begun.withColumn("_island", F.sum("_new").over(w)).groupBy(key, "_island").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    return islands.select(key, "_lo", "_hi")


def interval_keys(spans: DataFrame, cal: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """The distinct (key, session) within intervals. Bounds become positions first, so each
    interval is a sequence."""
    every = merged_intervals(spans, cal, key, start, end).select(key, F.explode(F.sequence("_lo", "_hi")).alias("pos"))
    return every.join(F.broadcast(cal), "pos").select(key, "session")


def flag(df: DataFrame, keys: DataFrame, on: Sequence[str], name: str) -> DataFrame:
    """Adds a boolean, whether the row's key is among keys."""
    return df.join(keys.select(*on).distinct().withColumn(name, F.lit(True)), list(on), "left").withColumn(name, F.coalesce(name, F.lit(False)))


def flag_within(df: DataFrame, intervals: DataFrame, entity: str, name: str) -> DataFrame:
    """Adds a boolean, whether the row's pos lies in one of its entity's merged_intervals. These are
    joined by entity alone, as one list that is shorter than the calendar, so a panel in buckets of entities stays where it is."""
    own = intervals.groupBy(entity).agg(F.collect_list(F.struct("_lo", "_hi")).alias("_spans"))
    here = F.exists("_spans", lambda x: F.col("pos").between(x["_lo"], x["_hi"]))
    return df.join(own, entity, "left").withColumn(name, F.coalesce(here, F.lit(False))).drop("_spans")


def eligible_labels(features: DataFrame, labels: DataFrame, universe: DataFrame, target: str) -> DataFrame:
    """Features with their labels and horizon, where the universe holds the row
    and the target is finite."""
    key = ["entity", "session"]
    ok = universe.where("in_model_universe").select(*key)
    return features.join(labels, key).join(ok, key, "left_semi").where(F.col(target).isNotNull() & ~F.isnan(target) & (F.abs(target) < float("inf")))


def in_force(rows: DataFrame, schedule: DataFrame, date: str, start: str, values: Sequence[str]) -> DataFrame:
    """The values of the schedule line in force on a date. A schedule is a short
    list of changes, and is sent to all tasks as one array."""
    lines = schedule.agg(F.sort_array(F.collect_list(F.struct(F.col(start).alias("from"), *values))).alias("_lines"))
    found = rows.crossJoin(F.broadcast(lines)).withColumn("_now", F.try_element_at(F.filter("_lines", lambda x: x["from"] <= F.col(date)), F.lit(-1)))
    return found.select(*rows.columns, *[F.col(f"_now.{v}").alias(v) for v in values])


def key_difference(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: the keys that both, only the first and only the second have."""
    both = a.select(*key).distinct().withColumn("_a", F.lit(1)).join(b.select(*key).distinct().withColumn("_b", F.lit(1)), list(key), "full")
    return both.agg(F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("n_both"), F.count_if(F.col("_b").isNull()).alias("n_left"), F.count_if(F.col("_a").isNull()).alias("n_right"))


def append_only(current: DataFrame, history: DataFrame, key: Sequence[str], content: Sequence[str]) -> DataFrame:
    """Current rows with `outcome`: append (new key), same (equal content), or
    conflict."""
    old = history.select(*key, F.xxhash64(*content).alias("_old"), F.lit(True).alias("_known"))
    both = current.join(old, list(key), "left")
    return both.withColumn("outcome", F.when(F.col("_known").isNull(), "append").when(F.col("_old") == F.xxhash64(*content), "same").otherwise("conflict")).drop("_old", "_known")


def limits_from(previous: str, up: float = 1.5, down: float = 0.5) -> tuple[Column, Column]:
    return F.col(previous) * up, F.col(previous) * down
