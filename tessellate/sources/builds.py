"""Tables that are built once and kept: a panel in buckets of entities, and feature and
label tables that grow by their newest sessions."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import TableSpec, footer_statistics, incremental_start, scan_table, upsert


def keep_in_buckets(df: DataFrame, root: str, entity: str = "entity", order: str = "pos", date: str = "session", buckets: int | None = None, dealt: bool = False) -> str:
    """A3: writes df to a table partitioned by the year of its date and bucketed by
    entity, and returns its name. Windows over an entity and joins on it read the buckets as
    they are, without an exchange; bounds on `year` prune folders. The rows
    are dealt by the buckets' own hash first, so a bucket is one file a year; dealt says that they are already."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"kept_{uuid.uuid4().hex}"
    rows = df.withColumn("year", F.year(date))
    rows = rows if dealt else rows.repartition(buckets, entity)
    rows.write.partitionBy("year").bucketBy(buckets, entity).sortBy(entity, order).option("path", f"{root.rstrip('/')}/{name}").saveAsTable(name)
    return name


def last_stored(spark: SparkSession, root: str, spec: TableSpec) -> str | None:
    """The last date of a stored table, from its footers; None where there is no table."""
    try:
        last = footer_statistics(spark, root, spec).first()["last"]
    except Exception as e:  # nothing stored yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None
    return None if last is None else last.isoformat()


def extend(spark: SparkSession, root: str, source: TableSpec, target: TableSpec, cal: DataFrame, make: Callable[[DataFrame], DataFrame], back: int, warm_up: int, parts: int | None = None) -> str | None:
    """Brings a target table up to date with its source. Rows from `back` sessions
    before the last stored one are made again, from the source's rows since `warm_up` sessions before
    these, and upserted; months before aren't read, and months that get no row aren't
    written. Returns the first session made, None if all were.

    make must need no more than warm_up sessions of history, and change no session more than
    `back` before the last. With parts, the source's rows are dealt into that many by the first column of the
    target's key beforehand, and the table's are."""
    dealt = lambda rows: rows.repartition(parts, target.key[0]) if parts else rows
    last = last_stored(spark, root, target)
    if last is None:
        upsert(spark, root, target, make(dealt(source.read(spark, root).drop("year", "month"))), parts)
        return None
    end = last_stored(spark, root, source)
    stored = spark.createDataFrame([(last,)], "d string").select(F.to_date("d").alias("d"))
    start = incremental_start(cal, stored, "d", back).first()["session"].isoformat()
    read_from = incremental_start(cal, stored, "d", back + warm_up).first()["session"].isoformat()
    rows = make(dealt(scan_table(spark, root, source, read_from, end)))
    upsert(spark, root, target, rows.where(F.col(target.date) >= F.to_date(F.lit(start))), parts)
    return start


def missing_counts(rows: DataFrame, features: Sequence[str], date: str = "session") -> DataFrame:
    """(day, feature, n_rows, n_missing) for each month, told by its first day; partial
    counts that add up."""
    one = rows.groupBy(F.to_date(F.date_trunc("month", date)).alias("day")).agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(f).isNull()).alias(f) for f in features])
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("n_missing")) for f in features])).alias("x")
    return one.select("day", "n_rows", each).select("day", "x.feature", "n_rows", "x.n_missing")


def update_missing_counts(spark: SparkSession, root: str, table: TableSpec, partials: TableSpec, features: Sequence[str], since: str | None) -> None:
    """counts the months of a table from that of `since` on (all of them where it is
    None) and upserts them among the kept counts."""
    rows = table.read(spark, root)
    if since:
        first = F.date_trunc("month", F.lit(since).cast("date"))
        rows = rows.where(F.col("year") * 12 + F.col("month") >= F.year(first) * 12 + F.month(first))
    upsert(spark, root, partials, missing_counts(rows, features, table.date))


def missing_ratios_of(partials: DataFrame) -> DataFrame:
    """(feature, missing_ratio) from kept counts."""
    return partials.groupBy("feature").agg((F.sum("n_missing") / F.sum("n_rows")).alias("missing_ratio"))
