"""Data-quality rules, gaps, reconciliations and freshness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expected:
    """A table that should be there: its folder, key, further required columns, and
    whether it may be absent or empty."""

    name: str
    path: str
    key: tuple[str, ...]
    required: tuple[str, ...] = ()
    optional: bool = False


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(at)


def table_set_status(spark: SparkSession, tables: Sequence[Expected]) -> DataFrame:
    """A row for each table: table, status, n_rows, duplicates (rows beyond the first
    of their key) and missing_columns. The status is `missing` (a required table that isn't
    there), `skipped` (an optional one that is absent or empty), `empty`, `invalid` (columns
    missing, or a key that isn't unique) or `valid`.

    The driver lists folders and schemas only. The tables that are there are counted in one
    plan, each by its distinct keys, so no table passes through one task."""
    shape = "`table` string, status string, n_rows long, duplicates long, missing_columns string"
    absent = [(t.name, "skipped" if t.optional else "missing", 0, 0, "") for t in tables if not _exists(spark, t.path)]
    out = spark.createDataFrame(absent, shape)
    for t in tables:
        if any(t.name == name for name, *_ in absent):
            continue
        rows = spark.read.parquet(t.path)
        lacking = [c for c in (*t.key, *t.required) if c not in rows.columns]
        if set(t.key) <= set(rows.columns):
            keyed = rows.groupBy(*t.key).agg(F.count(F.lit(1)).alias("n"))
            counted = keyed.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))
        else:
            counted = rows.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(0).cast("long").alias("duplicates"))
        bad = F.lit(bool(lacking)) | (F.col("duplicates") > 0)
        state = F.when(F.col("n_rows") == 0, "skipped" if t.optional else "empty").when(bad, "invalid").otherwise("valid")
        out = out.unionByName(counted.select(F.lit(t.name).alias("table"), state.alias("status"), "n_rows", "duplicates", F.lit(",".join(lacking)).alias("missing_columns")))
    return out


def status(df: DataFrame, required: Sequence[str], key: Sequence[str], table: str) -> DataFrame:
    """One row: missing columns, rows, duplicate keys, null keys, and the
    table's class (missing_columns, empty, invalid or valid)."""
    absent = [c for c in required if c not in df.columns]
    own = [c for c in key if c in df.columns]
    null_key = F.lit(False)
    for c in own:
        null_key = null_key | F.col(c).isNull()
    per_key = df.groupBy(*own).agg(F.count(F.lit(1)).alias("k")) if own else df.groupBy().agg(F.count(F.lit(1)).alias("k"))
    nulls = F.sum(F.when(null_key, F.col("k")).otherwise(0))
    one = per_key.agg(F.coalesce(F.sum("k"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(F.col("k") - 1), F.lit(0)).alias("duplicates"), F.coalesce(nulls, F.lit(0)).alias("null_keys"))
    kind = F.when(F.lit(bool(absent)), "missing_columns").when(F.col("n_rows") == 0, "empty").when((F.col("duplicates") > 0) | (F.col("null_keys") > 0), "invalid").otherwise("valid")
    return one.select(F.lit(table).alias("table"), F.lit(",".join(absent)).alias("missing_columns"), "n_rows", "duplicates", "null_keys", kind.alias("status"))


def rule_table(df: DataFrame, rules: Mapping[str, Column], table: str) -> DataFrame:
    """How many rows break each rule, all in one pass."""
    one = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()])
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").alias("violations")) for n in rules]))
    return one.select(each.alias("r")).select(F.lit(table).alias("table"), "r.*")


def violation_samples(df: DataFrame, rules: Mapping[str, Column], keys: Sequence[str], by: str | None = None, n: int = 3) -> DataFrame:
    """For each rule (and value of `by`) the rows that break it, and the first
    n of their keys in order. The sample is a top-n aggregate of short strings."""
    held = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in rules.items()]))
    groups = ([by] if by else []) + ["rule"]
    broken = df.select(*([by] if by else []), F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("_key"), F.explode(held).alias("rule"))
    counts = broken.groupBy(*groups).agg(F.count(F.lit(1)).alias("violations"))
    first = broken.withColumn("_r", F.row_number().over(Window.partitionBy(*groups).orderBy("_key"))).where(F.col("_r") <= n)
    return counts.join(first.groupBy(*groups).agg(F.array_join(F.sort_array(F.collect_list("_key")), ",").alias("samples")), groups)


def readiness(rows: DataFrame, eligible: Column, required: Sequence[str], back: int, least: int) -> DataFrame:
    """For each session the eligible rows, the share of required values that they
    lack, the rows that have them all, and that number against its median over the
    `back` sessions before."""
    lacks = sum((F.col(c).isNull().cast("double") for c in required), F.lit(0.0))
    one = rows.where(eligible).groupBy("session").agg(F.count(F.lit(1)).alias("eligible"), (F.avg(lacks) / len(required)).alias("missing_ratio"), F.count_if(lacks == 0).alias("surviving"))
    return against_baseline(one.withColumn("all", F.lit(1)), ["all"], "session", "surviving", back, least, 1).drop("all")


def signal_checks(signals: DataFrame, cal: DataFrame) -> DataFrame:
    """One row: signals on no open session, entries that aren't later than their
    signal, and (session, entity) more than once."""
    known = signals.join(F.broadcast(cal.select(F.col("session").alias("_s"))), signals["session"] == F.col("_s"), "left")
    late = known.agg(F.count_if(F.col("_s").isNull()).alias("off_calendar"), F.count_if(F.col("entry_session") <= F.col("session")).alias("not_later"))
    twice = signals.groupBy("session", "entity").agg(F.count(F.lit(1)).alias("k")).agg(F.coalesce(F.sum(F.col("k") - 1), F.lit(0)).alias("duplicates"))
    return late.crossJoin(F.broadcast(twice))


def duplicate_rows(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """How many rows beyond the first share their key."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("k")).agg(F.coalesce(F.sum(F.col("k") - 1), F.lit(0)).alias("n"))


def missing_sessions(df: DataFrame, cal: DataFrame) -> DataFrame:
    """The sessions since the table's first one on which it has no row."""
    first = df.agg(F.min("session").alias("_first"))
    return cal.crossJoin(F.broadcast(first)).where(F.col("session") >= F.col("_first")).join(df.select("session").distinct(), "session", "left_anti").select("session")


def session_gaps(df: DataFrame, cal: DataFrame, empty: DataFrame, start: str, end: str) -> DataFrame:
    """Sessions of a range without rows that are not marked as empty."""
    inside = cal.where(F.col("session").between(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).select("session")
    return inside.join(df.select("session").distinct(), "session", "left_anti").join(empty.select("session"), "session", "left_anti")


def entity_gaps(df: DataFrame, cal: DataFrame) -> DataFrame:
    """(entity, session) without a row, from each entity's first one on."""
    first = df.groupBy("entity").agg(F.min("session").alias("_first"))
    grid = first.crossJoin(F.broadcast(cal.select("session"))).where(F.col("session") >= F.col("_first"))
    return grid.join(df.select("entity", "session"), ["entity", "session"], "left_anti").select("entity", "session")


def infinite_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, infinite) for the columns that hold any infinity."""
    return rule_table(df, {c: F.abs(F.col(c)) == float("inf") for c in columns}, "").select(F.col("rule").alias("column"), F.col("violations").alias("infinite")).where("infinite > 0")


def reconcile(a: DataFrame, b: DataFrame, key: Sequence[str], tolerances: Mapping[str, float]) -> DataFrame:
    """(check, n): keys of one side only, and for each field the rows whose
    values differ by more than its tolerance; two nulls agree."""
    left = a.select(*key, *[F.col(c).alias(f"_a_{c}") for c in tolerances], F.lit(1).alias("_a"))
    right = b.select(*key, *[F.col(c).alias(f"_b_{c}") for c in tolerances], F.lit(1).alias("_b"))
    both = left.join(right, list(key), "full")
    met = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    rules = {"only_left": F.col("_b").isNull(), "only_right": F.col("_a").isNull()}
    for c, t in tolerances.items():
        x, y = F.col(f"_a_{c}"), F.col(f"_b_{c}")
        rules[f"{c}_differs"] = met & (x.isNull() != y.isNull()) | met & F.coalesce(F.abs(x - y) > t, F.lit(False))
    return rule_table(both, rules, "").select(F.col("rule").alias("check"), F.col("violations").alias("n"))


def against_baseline(counts: DataFrame, by: Sequence[str], order: str, n: str, back: int, least: int, floor: int, moderate: float = 0.8, severe: float = 0.5) -> DataFrame:
    """A count's ratio to the median of the `back` before it, in bands; below
    `floor` it is severe, and with fewer than `least` before it there is no baseline."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(-back, -1)
    out = counts.withColumns({"baseline": F.percentile(n, F.lit(0.5)).over(w), "_h": F.count(n).over(w)})
    out = out.withColumn("ratio", F.when(F.col("baseline") > 0, F.col(n) / F.col("baseline")))
    band = F.when(F.col(n) < floor, "severe").when(F.col("_h") < least, "short_history").when(F.col("ratio") < severe, "severe").when(F.col("ratio") < moderate, "moderate").otherwise("ok")
    return out.withColumn("band", band).drop("_h")


def freshness(tables: Mapping[str, tuple[DataFrame, str]], as_of: str) -> DataFrame:
    """Each table's last date, its lag in days, and the date all reach."""
    rows = None
    for name, (df, date) in tables.items():
        one = df.agg(F.max(F.to_date(date)).alias("last")).select(F.lit(name).alias("table"), "last")
        rows = one if rows is None else rows.unionByName(one)
    common = F.min("last").over(Window.partitionBy())
    return rows.select("table", "last", F.datediff(F.to_date(F.lit(as_of)), "last").alias("lag_days"), common.alias("common_end"))


def missing_entities(rows: DataFrame, required: DataFrame, date: str, as_of: str) -> DataFrame:
    """The required entities (entity) without a row on a date."""
    there = rows.where(F.to_date(date) == F.to_date(F.lit(as_of))).select("entity").distinct()
    return required.select("entity").distinct().join(there, "entity", "left_anti")


def limit_quality(limits: DataFrame, suspended: DataFrame, no_limit: tuple[float, float] = (99999.99, 0.0)) -> DataFrame:
    """Limit prices that are null, stand for no limit, are zero, inverted or
    negative; and zero ones on sessions that were not suspended."""
    up, down = F.col("up_limit"), F.col("down_limit")
    off = limits.join(suspended.select("entity", "session").distinct().withColumn("_s", F.lit(True)), ["entity", "session"], "left")
    sentinel = (F.abs(up - no_limit[0]) < 1e-6) & (F.abs(down - no_limit[1]) < 1e-6)
    zero = (up == 0) & (down == 0)
    return rule_table(
        off,
        {
            "null": up.isNull() | down.isNull(),
            "sentinel": sentinel,
            "zero": zero,
            "inverted": (up < down) & ~zero,
            "not_positive": ((up <= 0) | (down < 0)) & ~zero,
            "zero_not_suspended": zero & F.col("_s").isNull(),
        },
        "limits",
    )


def universe_rules() -> dict[str, Column]:
    """Implications of a universe table that rows break."""
    c = F.col
    model = c("in_model_universe")
    return {
        "model_but_new": model & c("is_new"),
        "model_but_restricted": model & c("is_restricted"),
        "model_without_price": model & c("is_no_price"),
        "model_but_illiquid": model & c("is_low_liquidity"),
        "reason_missing": ~model & (c("exclude_reason") == ""),
        "reason_needless": model & (c("exclude_reason") != ""),
        "price_without_trade": ~c("traded") & c("close").isNotNull(),
        "key_missing": c("entity").isNull() | c("session").isNull(),
    }


def label_rules(reasons: Sequence[str], quantiles: int) -> dict[str, Column]:
    """What label rows break: order of dates, nulls, ranges, known reasons."""
    c = F.col
    ok = c("is_label_available")
    return {
        "entry_not_after_signal": c("entry_session") <= c("session"),
        "exit_not_after_entry": c("exit_session") <= c("entry_session"),
        "available_without_return": ok & c("future_excess_ret").isNull(),
        "return_without_label": ~ok & c("future_excess_ret").isNotNull(),
        "reason_unknown": c("reason").isNotNull() & ~c("reason").isin(*reasons),
        "reason_missing": ~ok & c("reason").isNull(),
        "percentile_out_of_range": (c("label_pct") <= 0) | (c("label_pct") > 1),
        "quantile_out_of_range": (c("label_quantile") < 0) | (c("label_quantile") >= quantiles),
    }


def observation_rules(as_of: str) -> dict[str, Column]:
    """What observation rows break: known horizons and roles, no immature rows,
    a return just when it is available, non-empty ids."""
    c = F.col
    return {
        "role_unknown": ~c("model_role").isin("champion", "challenger", "ensemble"),
        "horizon_not_positive": c("horizon") <= 0,
        "immature": c("exit_session") > F.to_date(F.lit(as_of)),
        "signal_not_before_exit": c("session") >= c("exit_session"),
        "future_signal": c("session") > F.to_date(F.lit(as_of)),
        "id_missing": F.coalesce(F.length("observation_id"), F.lit(0)) == 0,
        "return_mismatch": (c("label_status") == "available") != c("y").isNotNull(),
    }
