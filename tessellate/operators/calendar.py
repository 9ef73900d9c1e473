"""Session calendars: tables of (session, pos) by which all windows are counted.

A calendar has a row for each session, some thousands in decades, so a window
without a partition key orders it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def open_sessions(days: DataFrame, session: str = "session", is_open: str | None = None) -> DataFrame:
    """B1: the ordered distinct open sessions with their position from 1."""
    if is_open:
        days = days.where(F.col(is_open) == 1)
    one = days.select(F.col(session).alias("session")).where("session IS NOT NULL").distinct()
    return one.withColumn("pos", F.row_number().over(Window.orderBy("session")))


def horizon_map(cal: DataFrame, horizons: Sequence[int]) -> DataFrame:
    """B2: for each session and horizon the entry (next) session and the exit
    (horizon after it); null past the calendar's end."""
    grid = cal.select("session", "pos", F.explode(F.array(*[F.lit(h) for h in horizons])).alias("horizon"))
    at = lambda name: cal.select(F.col("pos").alias(f"{name}_pos"), F.col("session").alias(f"{name}_session"))
    grid = grid.withColumn("entry_pos", F.col("pos") + 1).withColumn("exit_pos", F.col("pos") + 1 + F.col("horizon"))
    out = grid.join(F.broadcast(at("entry")), "entry_pos", "left").join(F.broadcast(at("exit")), "exit_pos", "left")
    return out.select("session", "pos", "horizon", "entry_session", "exit_session")


def session_age(rows: DataFrame, cal: DataFrame, start: str, session: str = "session") -> DataFrame:
    """Adds `age`, the sessions from a start date to the row's session, both
    counted, 0 before it. Before the calendar begins, 5 of 7 days count as sessions."""
    lead = cal.agg(F.min("session").alias("_first"))
    # the position of the first session at or after the start, by way of the days between
    nxt = cal.select(F.col("session").alias("_to"), F.col("pos").alias("_start_pos"), F.coalesce(F.date_add(F.lag("session").over(Window.orderBy("session")), 1), F.col("session")).alias("_from"))
    spans = nxt.select(F.explode(F.sequence("_from", "_to")).alias("_day"), "_start_pos")
    here = cal.select(F.col("session").alias("_s"), F.col("pos").alias("_pos"))
    out = rows.join(F.broadcast(here), rows[session] == F.col("_s"), "left").crossJoin(F.broadcast(lead))
    out = out.withColumn("_key", F.greatest(F.col(start), F.col("_first"))).join(F.broadcast(spans), F.col("_key") == F.col("_day"), "left")
    before = F.greatest(F.datediff("_first", F.col(start)), F.lit(0)) * 5
    age = F.greatest(F.col("_pos") - F.col("_start_pos") + 1, F.lit(0)) + F.floor(before / 7).cast("int")
    age = F.when(F.col(session) < F.col(start), F.lit(0)).otherwise(F.coalesce(age, F.lit(0)))
    return out.withColumn("age", age).drop("_first", "_s", "_pos", "_key", "_day", "_start_pos")


def period_ends(cal: DataFrame, unit: str) -> DataFrame:
    """The last session of each week, month or quarter."""
    return cal.groupBy(F.to_date(F.date_trunc(unit, "session")).alias("period")).agg(F.max("session").alias("session"))


def last_mature(cal: DataFrame, horizon: int) -> DataFrame:
    """The last session whose exit, horizon + 1 sessions on, is in the calendar."""
    return cal.crossJoin(cal.agg(F.max("pos").alias("top"))).where(F.col("pos") == F.col("top") - (horizon + 1)).select("session")


def executable_sessions(cal: DataFrame, horizon: int, delay: int) -> DataFrame:
    """The sessions that leave room for entry, horizon and a delayed exit."""
    return cal.crossJoin(cal.agg(F.max("pos").alias("top"))).where(F.col("pos") + horizon + delay + 1 <= F.col("top")).select("session", "pos")


def previous_sessions(cal: DataFrame, n: int) -> DataFrame:
    """(session, previous, back) for the n sessions before each session."""
    back = cal.select("session", "pos", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("back")).withColumn("p", F.col("pos") - F.col("back"))
    return back.join(F.broadcast(cal.select(F.col("pos").alias("p"), F.col("session").alias("previous"))), "p").select("session", "previous", "back")


def report_periods(spark, start: str, end: str, lookback_days: int) -> DataFrame:
    """The quarter ends that can be announced between two dates."""
    quarters = f"explode(sequence(date_trunc('quarter', date_sub(DATE'{start}', {lookback_days})), date_trunc('quarter', DATE'{end}'), INTERVAL 3 MONTHS))"
    return spark.sql(f"SELECT last_day(add_months(to_date(q), 2)) AS period FROM (SELECT {quarters} AS q)").where(f"period <= DATE'{end}' AND period >= date_sub(DATE'{start}', {lookback_days})")


def chunks(cal: DataFrame, unit: str) -> DataFrame:
    """Month or year chunks of a calendar with their first and last session."""
    return cal.groupBy(F.to_date(F.date_trunc(unit, "session")).alias("chunk")).agg(F.min("session").alias("first"), F.max("session").alias("last"), F.count(F.lit(1)).alias("n"))


def walk_forward_folds(cal: DataFrame, first: str, train: int | None, validation: int, horizons: Sequence[int], purge: int | None = None, embargo: int | None = None) -> DataFrame:
    """A fold for each month from `first` on. Before the evaluated month lie, in
    sessions: an embargo, `validation` sessions, a purge gap, and the training range
    (`train` sessions, or all from the start if None). Either gap is max(horizons) + 1
    unless given, and may not be smaller."""
    gap = max(horizons) + 1
    purge, embargo = gap if purge is None else purge, gap if embargo is None else embargo
    if purge < gap or embargo < gap:
        raise ValueError(f"purge and embargo must be {gap} sessions or more")
    month = cal.groupBy(F.to_date(F.date_trunc("month", "session")).alias("fold")).agg(F.min("pos").alias("eval_lo"), F.max("pos").alias("eval_hi")).where(F.col("fold") >= F.to_date(F.lit(first)))
    out = month.withColumn("val_hi", F.col("eval_lo") - 1 - embargo).withColumn("val_lo", F.col("val_hi") - validation + 1).withColumn("train_hi", F.col("val_lo") - 1 - purge)
    out = out.withColumn("train_lo", F.lit(1) if train is None else F.greatest(F.lit(1), F.col("train_hi") - train + 1))
    return out.where("train_hi >= train_lo").select("fold", "train_lo", "train_hi", "val_lo", "val_hi", "eval_lo", "eval_hi")


def assign_folds(cal: DataFrame, folds: DataFrame) -> DataFrame:
    """(session, fold, role); a session may be in many folds. Ranges are turned
    into positions, so that the join is on equality."""
    role = lambda name, lo, hi: folds.select("fold", F.lit(name).alias("role"), F.explode(F.sequence(F.col(lo).cast("int"), F.col(hi).cast("int"))).alias("pos"))
    every = role("train", "train_lo", "train_hi").unionAll(role("validation", "val_lo", "val_hi")).unionAll(role("evaluation", "eval_lo", "eval_hi"))
    return cal.join(every, "pos").select("session", "fold", "role")
