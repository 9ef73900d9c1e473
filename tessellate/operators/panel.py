"""From trade records to a panel: a row for each entity and session."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import col


def numeric(x: Column | str) -> Column:
    """A double, null where it can't be read as one or is NaN."""
    return F.nanvl(F.expr("try_cast(NULL AS double)") if x is None else col(x).try_cast("double"), F.lit(None).cast("double"))


def clean_date(x: Column | str) -> Column:
    """A date from YYYYMMDD text; blanks, sentinels and all else give null."""
    text = F.regexp_replace(F.trim(col(x).cast("string")), r"\.0$", "")
    return F.when(text.rlike(r"^\d{8}$"), F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date"))


def ohlc_ok(o: str = "open", h: str = "high", low: str = "low", c: str = "close") -> Column:
    """Prices are positive and high and low enclose the others."""
    good = (F.least(o, h, low, c) > 0) & (F.col(h) >= F.greatest(o, c, low)) & (F.col(low) <= F.least(o, c, h))
    return F.coalesce(good & F.col(o).isNotNull() & F.col(h).isNotNull() & F.col(low).isNotNull() & F.col(c).isNotNull(), F.lit(False))


def era_flags(bars: DataFrame, cut_off: str, session: str = "session") -> DataFrame:
    """Every bar with `is_valid` (its prices are good) and `is_kept`: bars with bad prices
    are kept from cut_off on only."""
    flagged = bars.withColumn("is_valid", ohlc_ok())
    return flagged.withColumn("is_kept", F.col("is_valid") | (F.col(session) >= F.to_date(F.lit(cut_off))))


def era_rule(bars: DataFrame, cut_off: str, session: str = "session") -> DataFrame:
    """Bars with bad prices are dropped before cut_off, and flagged from it on."""
    return era_flags(bars, cut_off, session).where("is_kept").drop("is_kept")


def keep_last(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """C4: of the rows of a key the last by order, which should be total."""
    spec = Window.partitionBy(*key).orderBy(*[col(x).desc() for x in order])
    return df.withColumn("_n", F.row_number().over(spec)).where("_n = 1").drop("_n")


def adjusted(bars: DataFrame, factors: DataFrame, key: Sequence[str], prices: Sequence[str], factor: str = "factor") -> DataFrame:
    """Adds adj_<price>, the price times the key's factor, null without one."""
    return bars.join(factors.select(*key, factor), list(key), "left").withColumns({f"adj_{p}": F.col(p) * F.col(factor) for p in prices})


def classify(x: Column | str, rules: Sequence[tuple[str, str]], other: str | None = None) -> Column:
    """The label of the first pattern that x matches."""
    out = F.lit(other)
    for pattern, label in reversed(rules):
        out = F.when(col(x).rlike(pattern), F.lit(label)).otherwise(out)
    return out


def has_marker(x: Column | str, marker: str) -> Column:
    """Whether a name, upper-cased and without spaces, holds a marker."""
    return F.coalesce(F.contains(F.upper(F.replace(col(x), F.lit(" "), F.lit(""))), F.lit(marker)), F.lit(False))


def complete(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Exactly the columns of schema, in order; absent ones are null."""
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in schema.items()])


def candidates(known: DataFrame, bars: DataFrame, entity: str = "entity") -> DataFrame:
    """All entities of either side; a missing list date is the first session."""
    seen = bars.groupBy(entity).agg(F.min("session").alias("first_session"), F.max("session").alias("last_session"))
    return known.join(seen, entity, "full").withColumn("list_date", F.coalesce("list_date", "first_session"))


def rescaled(df: DataFrame, units: Mapping[str, float]) -> DataFrame:
    """Columns multiplied by their unit."""
    return df.withColumns({c: F.col(c) * F.lit(float(u)) for c, u in units.items()})


def bars_of(trades: DataFrame, entity: str, session: Column, price: Column, volume: str, amount: str, order: Sequence[str]) -> DataFrame:
    """Bars of (entity, session): open and close are the first and last price by a
    total order of the trades."""
    at = F.struct(*order)
    rows = trades.select(F.col(entity).alias("entity"), session.alias("session"), price.alias("p"), F.col(volume).alias("v"), F.col(amount).alias("a"), at.alias("at"))
    return rows.groupBy("entity", "session").agg(
        F.min_by("p", "at").alias("open"), F.max("p").alias("high"), F.min("p").alias("low"), F.max_by("p", "at").alias("close"), F.sum("v").alias("vol"), F.sum("a").alias("amount")
    )


def densify(bars: DataFrame, cal: DataFrame, entities: DataFrame) -> DataFrame:
    """Every entity on every session, with `traded` where there is a bar. The
    calendar is the side that is sent to all tasks: it has a row per session."""
    grid = entities.crossJoin(F.broadcast(cal))
    marked = bars.withColumn("traded", F.lit(True))
    return grid.join(marked, ["entity", "session"], "left").withColumn("traded", F.coalesce("traded", F.lit(False)))


def spread_bars(bars: DataFrame, cal: DataFrame) -> DataFrame:
    """The entities that have bars on every session, as densify gives them, but without a
    join to a grid: each bar fills the sessions up to the next one, the first also those before it. Bars that
    are dealt by entity stay where they are. Bars without a session or an entity are not traded."""
    days = F.broadcast(cal.select("session", "pos"))
    values = [c for c in bars.columns if c not in ("entity", "session")]
    placed = bars.join(days, "session", "left").drop("session").crossJoin(F.broadcast(cal.agg(F.max("pos").alias("_n"))))
    e = Window.partitionBy("entity").orderBy("pos")
    first = F.when(F.row_number().over(e) == 1, F.lit(1)).otherwise(F.col("pos"))
    spans = placed.withColumns({"_from": first, "_to": F.coalesce(F.lead("pos").over(e) - 1, F.col("_n"))}).where("_from <= _to")
    each = spans.withColumn("_at", F.explode(F.sequence("_from", "_to")))
    here = F.col("entity").isNotNull() & F.col("pos").isNotNull() & (F.col("_at") == F.col("pos"))
    out = each.select("entity", F.col("_at").alias("pos"), *[F.when(here, F.col(c)).alias(c) for c in values], F.coalesce(here, F.lit(False)).alias("traded"))
    return out.join(days, "pos").select("entity", "session", "pos", *values, "traded")
