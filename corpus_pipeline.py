"""The corpus pipeline: five operators in a row over `documents`.

1. toxicity        rejects documents that score 0.7 or more; the model is fitted
                   on the stage's own rows and the labels in sf_dir.
2. line dedup      drops lines that a document with a smaller doc_id holds; a
                   document whose lines all go stays, with an empty text.
3. n-gram join     of each group of near duplicates the smallest doc_id stays;
                   of rows that share a doc_id, all stay or go together.
4. mixing          lays the documents out in the order of a stream that mixes the
                   sources by weight; the rows are written in that order.
5. packing         the sequences of 1024 tokens: a row for each piece. Places in the
                   stream follow from the rows alone, so they are worked out again,
                   whatever order the files are read in; each range of places is
                   packed by itself, and sequence_id follows the stream.

Each stage's result is written as Parquet and read again as the next one's input.
All but the last return the columns of documents, n_chars brought up to date.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellate.llm.common import delete_folder, shared_dir, table, temporaries
from tessellate.llm.jaccard_join import jaccard_components
from tessellate.llm.line_dedup import dedup_lines
from tessellate.llm.mixing import mix
from tessellate.llm.packing import pack_documents
from tessellate.llm.toxicity import fit_toxicity

#: Pieces in a range of the stream that is packed by itself: the fewer, the closer
#: sequences follow the stream, and the more sequences are left partly filled.
RANGE_ROWS = 5000
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that score below 0.7, with their own columns, whatever those are named.
    Null and empty texts score as texts without votes, and rows without doc_id teach
    nothing; repeated rows are each judged. Without labels, fixed lists decide."""
    return fit_toxicity(docs, table(spark, sf_dir, "labels")).keep_clean(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, with the lines that smaller doc_ids hold taken out of its text and
    n_chars brought up to date. Null text becomes empty; repeated rows count as one
    document; a row without doc_id keeps its text. Other columns are kept."""
    kept = dedup_lines(docs, carry=tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars")))
    own = {"doc_id": F.col("doc_id"), "text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return kept.select(*[own[c].alias(c) if c in own else F.col(f"carried.`{c}`") for c in docs.columns])


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows whose doc_id is the smallest of its component. Null and empty texts and
    rows without doc_id are components of their own; repeated rows stay or go together."""
    gone = jaccard_components(docs, count=False).where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, in the order of the mixed stream. A null source is a source; repeated
    rows each have their place; rows without doc_id come first in their source."""
    mixed = mix(docs, carry=tuple(c for c in docs.columns if c not in ("doc_id", "source")))
    mixed = mixed.repartitionByRange(F.col("place").asc_nulls_last(), "doc_id").sortWithinPartitions(F.col("place").asc_nulls_last(), "doc_id")
    return mixed.select(*[F.col(c) if c in ("doc_id", "source") else F.col(f"carried.`{c}`") for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each row, packed in ranges of the stream. Null text is
    the end token alone; a null doc_id stays null; other columns are left behind."""
    placed = mix(docs, carry=("text",)).select("doc_id", "carried.text", "place")
    return pack_documents(placed, group_rows=RANGE_ROWS, order="place").drop("place")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over the documents of sf_dir. What a stage stages on
    its way is deleted once its result is written, and its input after that; the last
    result stays, for the frame that is returned reads it."""
    docs = table(spark, sf_dir, "documents")
    home = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        with temporaries(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{home}/{k}")
        docs = spark.read.parquet(f"{home}/{k}")
        if k:
            delete_folder(spark, f"{home}/{k - 1}")
    return docs


#: A fitted classifier and a tokenizer can't be written in SQL; the tests check the
#: stages against plain versions instead.
ORACLE_SQL: str | None = None
