"""Partitioned Parquet tables: scans, idempotent upserts, snapshots and statistics."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TableSpec:
    """A table's name, key and date column, and its columns as a schema string if they
    are known; tables are partitioned by year and month. With a schema no file's footer
    is read for planning; without, files may differ and all footers are merged."""

    name: str
    key: tuple[str, ...]
    date: str = "session"
    schema: str | None = None

    def read(self, spark: SparkSession, root: str) -> DataFrame:
        if self.schema:
            return spark.read.schema(f"{self.schema}, year int, month int").parquet(self.path(root))
        return spark.read.option("mergeSchema", "true").parquet(self.path(root))

    def path(self, root: str) -> str:
        return f"{root.rstrip('/')}/{self.name}"


def _with_month(df: DataFrame, date: str) -> DataFrame:
    return df.withColumn("year", F.year(date)).withColumn("month", F.month(date))


def scan_table(spark: SparkSession, root: str, spec: TableSpec, start: str, end: str, columns: Sequence[str] = ("*",)) -> DataFrame:
    """A1, A2: rows of a date range, both ends included. The months of the range
    prune partitions; dates and columns go down to the scan."""
    s, e = F.to_date(F.lit(start)), F.to_date(F.lit(end))
    month = F.col("year") * 12 + F.col("month")
    inside = month.between(F.year(s) * 12 + F.month(s), F.year(e) * 12 + F.month(e))
    df = spec.read(spark, root).where(inside & F.col(spec.date).between(s, e))
    return df.drop("year", "month").select(*columns)


def merged(old: DataFrame, new: DataFrame, key: Sequence[str], order: Sequence[Column] = (), deal: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """A3: old and new rows by key, new ones first; among new rows the last by order. deal shuffles both by
    the key or some of it, if that isn't left to the window."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    both = deal(both) if deal else both
    spec = Window.partitionBy(*key).orderBy(F.desc("_new"), *order)
    return both.withColumn("_n", F.row_number().over(spec)).where("_n = 1").drop("_n", "_new")


#: For how many parts of a table a month has a file at least.
PARTS_A_FILE = 64


def upsert(spark: SparkSession, root: str, spec: TableSpec, new: DataFrame, parts: int | None = None) -> None:
    """A3: writes rows into their months, replacing rows of the same key; repeating it
    changes nothing. Dynamic overwriting puts the months touched in place when all are written, so they can be
    read meanwhile and are written once. Where the key holds the date, rows are shuffled once, by
    month, and the window over the key finds them so; with parts, into that many, and months into files by key."""
    path = spec.path(root)
    fresh = _with_month(new, spec.date)
    order = [F.col(c).desc_nulls_last() for c in new.columns if c not in spec.key]
    try:
        stored = spec.read(spark, root)
    except Exception as e:  # the first write
        if "PATH_NOT_FOUND" not in str(e):
            raise
        stored = fresh.limit(0)
    months = F.broadcast(fresh.select("year", "month").distinct())
    touched = stored.join(months, ["year", "month"], "left_semi")
    number = [parts] if parts else []
    if spec.date in spec.key:
        own = [c for c in spec.key if c != spec.date] or [spec.date]
        file = F.pmod(F.xxhash64(*own), F.lit(math.ceil((parts or 1) / PARTS_A_FILE)))
        by = ["year", "month", "_file"]
        rows = merged(touched, fresh, [*by, *spec.key], order, lambda both: both.withColumn("_file", file).repartition(*number, *by)).drop("_file")
    else:
        rows = merged(touched, fresh, spec.key, order).repartition(*number, "year", "month")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(path)


def replace_snapshot(df: DataFrame, path: str, key: Sequence[str], order: Sequence[str]) -> None:
    """A4: overwrites a snapshot with a row for each key; an empty one is refused."""
    if df.isEmpty():
        raise ValueError("a snapshot may not be replaced by an empty table")
    spec = Window.partitionBy(*key).orderBy(*[F.desc(c) for c in order])
    df.withColumn("_n", F.row_number().over(spec)).where("_n = 1").drop("_n").write.mode("overwrite").parquet(path)


def table_status(df: DataFrame, date: str, flags: Sequence[str] = ()) -> DataFrame:
    """Rows, months, first and last date, and the count of each flag, in one
    aggregate."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(F.date_trunc("month", date)).alias("n_months"), F.min(date).alias("first"), F.max(date).alias("last"), *[F.count_if(F.coalesce(F.col(f), F.lit(False))).alias(f"n_{f}") for f in flags])


def _reading_footers(spark: SparkSession) -> SparkSession:
    """A session of the same application whose Parquet scans answer counts, least and
    greatest values from the files' footers."""
    own = spark.newSession()
    v1 = [x for x in own.conf.get("spark.sql.sources.useV1SourceList", "").split(",") if x.strip().lower() != "parquet"]
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(v1))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return own


def footer_statistics(spark: SparkSession, root: str, spec: TableSpec, counted: Sequence[str] = ()) -> DataFrame:
    """Rows, partitions, first and last date of a stored table, and for each of
    `counted` how many rows have a value (n_...), without reading a data page: the
    aggregate by partition goes down to the scan, which takes it from the footers. Files
    without statistics fail there; table_status reads the rows instead."""
    table = spec.read(_reading_footers(spark), root)
    by_month = table.groupBy("year", "month").agg(F.count(F.lit(1)).alias("_n"), F.min(spec.date).alias("_first"), F.max(spec.date).alias("_last"), *[F.count(c).alias(f"_n_{c}") for c in counted])
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return by_month.agg(zero("_n").alias("n_rows"), F.count(F.lit(1)).alias("n_partitions"), F.min("_first").alias("first"), F.max("_last").alias("last"), *[zero(f"_n_{c}").alias(f"n_{c}") for c in counted])


def schema_table(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """A row for each column that any file of a stored table has: column_name,
    data_type, nullable. Footers are merged by tasks; only their schemas are read."""
    merged_schema = spark.read.option("mergeSchema", "true").parquet(spec.path(root)).schema
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in merged_schema]
    return spark.createDataFrame(rows, "column_name string, data_type string, nullable boolean")


def content_hash(df: DataFrame) -> DataFrame:
    """A hash of a table's rows that doesn't depend on their order: the count, and
    the sum and exclusive or of 60 bits of each row's MD5. Values count by their strings,
    a null apart from an empty one."""
    row = F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("null")) for c in df.columns])
    h = F.conv(F.substring(F.md5(row.cast("binary")), 1, 15), 16, 10).cast("long")
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(38,0)")).cast("string").alias("total"), F.bit_xor(h).alias("mixed"))


def incremental_start(cal: DataFrame, stored: DataFrame, date: str, back: int) -> DataFrame:
    """The session `back` before the last stored one, from which to fetch again."""
    last = stored.agg(F.max(date).alias("_last"))
    at = cal.crossJoin(F.broadcast(last)).where(F.col("session") <= F.col("_last")).agg(F.max("pos").alias("_p"))
    return cal.crossJoin(F.broadcast(at)).where(F.col("pos") == F.greatest(F.lit(1), F.col("_p") - back)).select("session")


def write_metrics(df: DataFrame, path: str, kind: str = "csv") -> None:
    """A10: a metric table as CSV with a header, or as JSON lines."""
    writer = df.write.mode("overwrite")
    writer.option("header", True).csv(path) if kind == "csv" else writer.json(path)


def append_events(results: DataFrame, path: str, date: str) -> None:
    """Validation results appended as JSON under their date."""
    results.withColumn("date", F.to_date(F.lit(date))).write.mode("append").partitionBy("date").json(path)
