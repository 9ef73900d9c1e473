"""Removal of lines that an earlier document already holds.

The index of seen lines is a set of sorted runs, kept in levels as in a
log-structured merge tree: each batch of documents adds one run of level 0, and
`fanout` runs of a level are merged into one of the next. A run is a table of
(h1, h2, doc_id), bucketed and sorted by the 128-bit hash of a line's key, so a
batch is anti-joined with the runs bucket by bucket, and there are only
O(fanout * log(batches)) runs to merge with. Runs hold different lines, so a full outer
merge join of them is their merged run: compaction moves nothing between buckets.

Texts are split and hashed once: the lines of all batches are written by batch, a
line once for each batch that has it, and the batches are read from there.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WHITE, ascii_lower, modest_batches, staged, unstage

_STRIP = WHITE.encode()
_UNIQUE = "h1 long, h2 long, doc_id long"


def line_keys(docs: DataFrame, min_chars: int = 10, *more: str) -> DataFrame:
    """(h1, h2, doc_id) and the columns that `more` names: the hashes of the keys of at
    least min_chars code points in each document that has an id, a key once or more."""
    line = F.explode(F.split(F.coalesce("text", F.lit("")), "\n"))
    key = ascii_lower(F.btrim(F.col("line"), F.lit(WHITE)))
    return (
        docs.where(F.col("doc_id").isNotNull())
        .select("doc_id", *more, line.alias("line"))
        .select("doc_id", *more, key.alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", *more)
    )


class LineRuns:
    """The levelled runs. Batches must come in ascending order of doc_id, so that
    the first holder of a line is the one with the smallest id."""

    def __init__(self, spark: SparkSession, fanout: int = 4, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]
        self._name = f"line_runs_{uuid.uuid4().hex}"
        self._made = 0

    def _write(self, df: DataFrame) -> str:
        """Tasks must hold a bucket each, as after a shuffle by the buckets' columns
        or a join of bucketed runs."""
        name = f"{self._name}_{self._made}"
        self._made += 1
        df.write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").format("parquet").saveAsTable(name)
        return name

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(x) for level in self.levels for x in level]

    def add(self, lines: DataFrame) -> None:
        """Adds the lines of a batch that no run holds. lines has (h1, h2, doc_id), a row
        for each line, with its first holder in the batch."""
        fresh = lines.repartition(self.buckets, "h1", "h2")
        for run in self.runs():
            fresh = fresh.join(run.select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
        self.levels[0].append(self._write(fresh))
        self._compact()

    def _compact(self) -> None:
        for i, level in enumerate(self.levels):
            if len(level) >= self.fanout:
                if i + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[i + 1].append(self._write(self._merged(level)))
                for x in level:
                    self.spark.sql(f"DROP TABLE {x}")
                level.clear()

    def _merged(self, names: list[str]) -> DataFrame:
        out = self.spark.table(names[0])
        for x in names[1:]:
            more = self.spark.table(x).withColumnRenamed("doc_id", "more").hint("merge")
            out = out.join(more, ["h1", "h2"], "full").select("h1", "h2", F.coalesce("doc_id", "more").alias("doc_id"))
        return out

    def owners(self) -> DataFrame:
        """(h1, h2, doc_id) of every line seen: a line has one row."""
        runs = self.runs()
        out = runs[0] if runs else self.spark.createDataFrame([], _UNIQUE)
        for x in runs[1:]:
            out = out.unionAll(x)
        return out

    def drop(self) -> None:
        for level in self.levels:
            for x in level:
                self.spark.sql(f"DROP TABLE {x}")
        self.levels = [[]]


def _hash(key: bytes) -> int:
    """xxhash64(key) as Spark has it: seed 42, signed."""
    h = xxhash.xxh64_intdigest(key, 42)
    return h - (1 << 64) if h >> 63 else h


def _keep(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, owned, has_id = (b.column(b.schema.get_field_index(x)) for x in ("text", "owned", "has_id"))
            lines_n, dropped, kept, digests = [], [], [], []
            for text, own, known in zip(texts, owned, has_id, strict=True):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                lines = data.split(b"\n")
                mine = set(own.values.to_numpy(zero_copy_only=False).tolist()) if own.is_valid else set()
                out = lines
                if known.as_py():
                    out = []
                    for line in lines:
                        key = line.strip(_STRIP).lower()
                        if (
                            len(key) < min_chars
                            or _hash(key) in mine
                            or len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars
                        ):
                            out.append(line)
                joined = b"\n".join(out)
                lines_n.append(len(lines))
                dropped.append(len(lines) - len(out))
                kept.append(joined.decode("utf-8", "replace"))
                digests.append(hashlib.sha256(joined).hexdigest())
            rest = [x for x in b.schema.names if x not in ("text", "owned", "has_id")]
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index(x)) for x in rest]
                + [pa.array(kept, pa.string()), pa.array(lines_n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(digests, pa.string())],
                [*rest, "kept_text", "n_lines", "n_dropped", "kept_sha256"],
            )

    return run


def dedup_lines(docs: DataFrame, min_chars: int = 10, batches: int = 6, fanout: int = 3, batch_rows: int = 100_000_000, carry: tuple[str, ...] = ()) -> DataFrame:
    """Splits each text at line feeds and drops every line whose key (stripped of
    ASCII white space, A-Z lower-cased) has min_chars code points or more and is
    held by a document with a smaller doc_id. Lines of one document never drop
    each other.

    There are `batches` batches, or more, of about batch_rows rows each. Returns
    doc_id, kept_text, n_lines, n_dropped and kept_sha256, a row for each row of docs,
    and with carry a struct `carried` of the columns that it names.

    Null or empty text is one empty line. Rows that share a doc_id count as one
    document. A row without doc_id keeps all its lines and owns none. An empty
    table gives an empty result. Other columns, whatever their names, are ignored
    unless carried, and then they stay inside their struct.
    """
    spark = docs.sparkSession
    modest_batches(docs.sparkSession)
    carried = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carried")] if carry else []
    docs = docs.select("doc_id", "text", *carried)
    batches = max(batches, -(-docs.count() // batch_rows))
    ids = docs.select("doc_id")
    cuts = sorted({int(x) for x in ids.approxQuantile("doc_id", [i / batches for i in range(1, batches)], 0.02)}) if batches > 1 else []
    starts = F.array(*[F.lit(x).cast("long") for x in cuts]).cast("array<long>")
    batch = F.size(F.filter(starts, lambda start: start <= F.col("doc_id")))
    keys = line_keys(docs.select("doc_id", "text", batch.alias("batch")), min_chars, "batch")
    lines = staged(keys.groupBy("batch", "h1", "h2").agg(F.min("doc_id").alias("doc_id")), "batch")
    runs = LineRuns(spark, fanout)
    for k in range(len(cuts) + 1):
        runs.add(lines.where(F.col("batch") == k).drop("batch"))
    # 64 bits tell apart the lines of one document, so the second hash stays behind
    owned = staged(runs.owners().groupBy("doc_id").agg(F.collect_list("h1").alias("owned")))
    runs.drop()
    unstage(lines)
    joined = docs.withColumn("has_id", F.col("doc_id").isNotNull()).join(owned, "doc_id", "left")
    joined = joined.select("doc_id", *docs.columns[2:], "text", "has_id", "owned")
    schema = docs.drop("text").schema
    for name, kind in (("kept_text", "string"), ("n_lines", "long"), ("n_dropped", "long"), ("kept_sha256", "string")):
        schema = schema.add(name, kind)
    return joined.mapInArrow(_keep(min_chars), schema)
