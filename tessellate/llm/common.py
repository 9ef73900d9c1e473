"""Small helpers that the corpus operators share."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that the contracts name: space, tab to carriage return.
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def modest_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Python gets texts in batches of so many rows, where the session leaves the
    number at its default, which would be many megabytes of long texts at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(rows))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the
    session. Where it is unset on one machine, as in tests, a temporary one."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


#: Of each open temporaries(), the folders that it will delete.
_OPEN: list[list[str]] = []


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


@contextmanager
def temporaries(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what staged() wrote inside it. Operators return plans that
    still read such tables, so their results must have been written by then."""
    _OPEN.append([])
    try:
        yield
    finally:
        for folder in _OPEN.pop():
            delete_folder(spark, folder)


def staged(df: DataFrame, *by: str) -> DataFrame:
    """Writes df as Parquet to the shared folder, with `by` in folders of their own, and
    reads it again, which cuts the lineage: a lost executor then costs a reread, not a
    recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/staged-{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(path)
    df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """As staged(), in buckets of `key`, as many as shuffles have partitions: joins on
    key read it without an exchange. The table's name is not kept."""
    spark = df.sparkSession
    name = f"staged_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{name.replace('_', '-')}"
    if _OPEN:
        _OPEN[-1].append(path)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").bucketBy(parts, key).option("path", path).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    return out


def free_shuffles(spark: SparkSession) -> None:
    """Has the files of shuffles that nothing can read any more deleted. Spark keeps them
    until the driver collects its garbage, which a large driver may not do for long."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def unstage(*frames: DataFrame) -> None:
    """Deletes what staged() wrote for these frames; nothing may read them later."""
    for df in frames:
        for home, name in {tuple(f.rsplit("/staged-", 1)) for f in df.inputFiles() if "/staged-" in f}:
            delete_folder(df.sparkSession, f"{home}/staged-{name.split('/')[0]}")


def bounded_sample(rows: DataFrame, key: str, n: int, total: int | None = None) -> DataFrame:
    """The n rows whose keys have the least hashes, more only where rows share a key.

    A threshold on the hash leaves about 3 n / 2 rows first, so that what is sorted
    and broadcast is bounded by n, and not by the table. total, the number of rows or
    a little more, spares a count."""
    total = rows.count() if total is None else total
    space = 1 << 30
    h = F.xxhash64(key)
    near = rows.where(F.pmod(h, F.lit(space)) < int(min(1.0, 1.5 * n / max(total, 1)) * space))
    ids = near.select(key, F.pmod(h, F.lit(space)).alias("_h")).distinct().orderBy("_h", key).limit(n).select(key)
    return near.join(F.broadcast(ids), key, "left_semi")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def chunk_of(df: DataFrame, key: str, rows: int = 500, most: int = 4096) -> DataFrame:
    """Adds `chunk`, a number that grows with key: ranges of about `rows` rows,
    `most` ranges at most. Rows with one key share a chunk; a null key is chunk 0.

    The bounds are approximate quantiles, so no range depends on dense keys."""
    n = df.count()
    parts = max(1, min(most, -(-n // rows)))
    cuts = df.approxQuantile(key, [i / parts for i in range(1, parts)], 0.2 / parts) if parts > 1 else []
    cuts = sorted({int(x) for x in cuts})
    if not cuts:
        return df.withColumn("chunk", F.lit(0))
    # the count of cuts at or below the key, by binary search in an array literal
    bounds = F.array(*[F.lit(x).cast("long") for x in cuts]) if len(cuts) < 64 else F.from_json(F.lit(str(cuts)), "array<bigint>")
    steps = max(1, len(cuts)).bit_length() + 1
    found = F.aggregate(
        F.sequence(F.lit(1), F.lit(steps)),
        F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi")),
        lambda a, _: F.when(
            a["lo"] < a["hi"],
            F.when(
                F.get(bounds, F.floor((a["lo"] + a["hi"]) / 2).cast("int")) <= F.col(key),
                F.struct((F.floor((a["lo"] + a["hi"]) / 2) + 1).cast("int").alias("lo"), a["hi"].alias("hi")),
            ).otherwise(F.struct(a["lo"].alias("lo"), F.floor((a["lo"] + a["hi"]) / 2).cast("int").alias("hi"))),
        ).otherwise(a),
    )["lo"]
    return df.withColumn("chunk", F.when(F.col(key).isNull(), F.lit(0)).otherwise(found))
