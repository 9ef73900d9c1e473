"""Interleaving of sources by target weights.

A source's documents are laid out in blocks of about block_chars characters. Block
j = 0, 1, ... of a source with weight w may start at floor(j / w) and is due at
ceil((j + 1) / w), both in blocks of the mixed stream; at each place, the block
that has been released and is due first goes next. That is Pfair scheduling: after
any number t of places, a source with weight w has had more than t w - 1 and less
than t w + 1 blocks.

Weights are whole numbers of places in a period, so the schedule repeats and only
one period of it is worked out, in a SQL fold. The place of a block follows from
its number alone, and so the stream is never sorted or counted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import chunk_of, staged

#: The column by which null sources are told apart from a source with an empty name.
NO_SOURCE = "source is null"


def source_sizes(docs: DataFrame) -> DataFrame:
    """(source, n_docs, chars) of each source; null is a source of its own."""
    return docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.char_length(F.coalesce("text", F.lit("")))).alias("chars"))


def target_shares(sizes: DataFrame, period: int = 1000, power: float = 0.5) -> DataFrame:
    """Adds `share`, the places of a source in a period: in proportion to chars to
    the given power, rounded by largest remainder so that shares sum to period,
    with one place at least. There must be no more sources than places.

    Weights below 1 / period can't be kept; choose a longer period for them."""
    everything = Window.partitionBy()
    mass = F.greatest(F.pow(F.col("chars").cast("double"), F.lit(power)), F.lit(1e-9))
    free = F.lit(period) - F.count(F.lit(1)).over(everything)
    ideal = mass / F.sum(mass).over(everything) * free
    ranked = Window.partitionBy().orderBy(F.desc("part"), F.col("source").asc_nulls_first())
    left = free - F.sum(F.floor("ideal")).over(everything)
    return (
        sizes.withColumn("ideal", ideal)
        .withColumn("part", F.col("ideal") - F.floor("ideal"))
        .withColumn("share", (1 + F.floor("ideal") + F.when(F.row_number().over(ranked) <= left, 1).otherwise(0)).cast("int"))
        .drop("ideal", "part")
    )


def _edf(shares: Column, period: int) -> Column:
    """The numbers (from 0) of the sources of an array of shares at each place of a
    period, by earliest deadline first among the released blocks. The state is the
    count of blocks that each source has had; a tie goes to the larger share."""
    share = lambda i: F.get(shares, i)
    had = lambda state, i: F.get(state["had"], i)

    def due(state: Column, i: Column) -> Column:
        return F.ceil((had(state, i) + 1) * period / share(i))

    def step(state: Column, place: Column) -> Column:
        ready = F.filter(
            F.transform(
                F.sequence(F.lit(0), F.size(shares) - 1),
                lambda i: F.when(
                    F.floor(had(state, i) * period / share(i)) <= place,
                    F.struct(due(state, i).alias("due"), (-share(i)).alias("share"), i.alias("i")),
                ),
            ),
            lambda x: x.isNotNull(),
        )
        return F.array_min(ready)["i"]

    start = F.struct(F.transform(shares, lambda _: F.lit(0)).alias("had"), F.array().cast("array<int>").alias("out"), F.lit(0).alias("now"))

    def advance(state: Column, place: Column) -> Column:
        # in two folds, so that the chosen number is worked out once
        return F.aggregate(
            F.array(step(state, place)),
            state,
            lambda s, i: F.struct(
                F.transform(s["had"], lambda h, k: h + F.when(k == i, 1).otherwise(0)).alias("had"),
                F.concat(s["out"], F.array(i)).alias("out"),
                (s["now"] + 1).alias("now"),
            ),
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(period - 1)), start, advance)["out"]


def schedule(shares: DataFrame, period: int) -> DataFrame:
    """One row for each source: source, share, its number, and `places`, the sorted
    places of a period that are its own. Its size is sources times period, whatever
    the corpus holds."""
    ordered = Window.partitionBy().orderBy(F.col("source").asc_nulls_first())
    numbered = shares.withColumn("number", (F.row_number().over(ordered) - 1).cast("int"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("number", "share"))), lambda x: x["share"])
    plan = numbered.agg(listed.alias("shares")).select(_edf(F.col("shares"), period).alias("plan"))
    own = F.filter(F.transform("plan", lambda x, t: F.when(x == F.col("number"), t.cast("int"))), lambda t: t.isNotNull())
    return numbered.join(F.broadcast(plan)).select("source", "share", "number", own.alias("places"))


def block_numbers(docs: DataFrame, block_chars: int) -> DataFrame:
    """(doc_id, source, tie, block): the number of a document's block in its source,
    the characters of the documents before it (by doc_id) over block_chars. A document
    of several blocks' length stands for all of them, so numbers may be skipped after
    it. docs has doc_id, source, tie (a hash of the text) and size; equal rows are one.

    The running sums are taken in ranges of doc_id, and the ranges' totals added, so
    that a source that holds most rows is spread over many tasks. Texts stay out."""
    one = docs.groupBy("doc_id", "source", "tie").agg(F.sum("size").alias("size"))
    sized = chunk_of(staged(one), "doc_id", rows=2000)
    totals = sized.groupBy("source", "chunk").agg(F.sum("size").alias("total"))
    before = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("source").alias("s"), F.col("chunk").alias("c"), F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "chunk").orderBy("doc_id", "tie").rowsBetween(Window.unboundedPreceding, -1)
    begins = F.col("base") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    joined = sized.join(totals, F.col("source").eqNullSafe(F.col("s")) & (F.col("chunk") == F.col("c")))
    return joined.select("doc_id", "source", "tie", F.floor(begins / block_chars).alias("block"))


def mix(docs: DataFrame, weights: DataFrame | None = None, period: int = 1000, block_chars: int = 65_536, power: float = 0.5, carry: tuple[str, ...] = ()) -> DataFrame:
    """Gives every document its place in a stream that mixes the sources by target
    weights.

    weights has (source, share) with shares that sum to period; without it the
    shares follow from each source's characters to the given power. Returns
    doc_id, source, a struct `carried` of the columns that carry names (if any), block
    (number in its source), slot (the
    block's place in the schedule), place (the same without the empty places that
    sources leave once they have run out) and on_target (whether the stream is
    still complete there: every source then has within one block of its weight).

    Without weights the period grows to four places for each source, so that all of
    any number of sources have one. No row is dropped or repeated. A null source is a source of its own; null or
    empty text counts as one character; rows without doc_id come first in their
    source; repeated rows are kept, each with its block. A source that weights
    doesn't name has no slot, and comes after the mixed stream, in null places. An
    empty table gives an empty result.
    """
    size = F.greatest(F.char_length(F.coalesce("text", F.lit(""))), F.lit(1)).cast("long")
    blocks = staged(block_numbers(docs.select("doc_id", "source", F.xxhash64("text").alias("tie"), size.alias("size")), block_chars))
    if weights is None:
        sizes = staged(source_sizes(docs))
        period = max(period, 4 * sizes.count())  # so that every source has a place
        weights = target_shares(sizes, period, power)
    plan = staged(schedule(weights, period))
    extent = blocks.groupBy("source").agg((F.max("block") + 1).alias("n_blocks"))
    # one row for each source of the plan; the last place that all sources fill
    s = F.col("share").cast("long")
    known = plan.join(extent.withColumnRenamed("source", "x"), F.col("source").eqNullSafe(F.col("x")), "left").withColumn("n_blocks", F.coalesce("n_blocks", F.lit(0))).drop("x")
    ends = F.floor(F.col("n_blocks") / s) * period + F.get("places", (F.col("n_blocks") % s).cast("int"))
    sources = staged(known.withColumn("ends", ends))
    whole = sources.agg(F.min("ends").alias("horizon"), F.array_sort(F.collect_list(F.struct("number", "share", "n_blocks", "places"))).alias("all"))
    mine = sources.select(F.col("source").alias("x"), "share", "places")
    slot = F.floor(F.col("block") / F.col("share")) * period + F.get("places", (F.col("block") % F.col("share")).cast("int"))
    # blocks are few beside documents: places are worked out for each block
    numbered = (
        blocks.groupBy("source", "block").agg(F.count(F.lit(1)).alias("in_block"))
        .join(mine, F.col("source").eqNullSafe(F.col("x")))
        .select(F.col("source").alias("x"), F.col("block").alias("b"), slot.alias("slot"))
        .join(F.broadcast(whole))
    )
    rest, turn = F.col("slot") % period, F.floor(F.col("slot") / period)
    before = F.aggregate(
        F.transform("all", lambda a: F.least(a["n_blocks"], turn * a["share"] + F.size(F.filter(a["places"], lambda p: p < rest)))),
        F.lit(0).cast("long"),
        lambda total, n: total + n,
    )
    placed = numbered.select("x", "b", "slot", before.alias("place"), (F.col("slot") < F.col("horizon")).alias("on_target"))
    out = blocks.join(placed, F.col("source").eqNullSafe(F.col("x")) & (F.col("block") == F.col("b")), "left")
    out = out.select(F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("tie").alias("_t"), "block", "slot", "place", F.coalesce("on_target", F.lit(False)).alias("on_target"))
    carried = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carried")] if carry else []
    rows = docs.select("doc_id", "source", *carried, F.xxhash64("text").alias("_tie"))
    whole = rows.join(out, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("source").eqNullSafe(F.col("_s")) & (F.col("_tie") == F.col("_t")))
    return whole.select("doc_id", "source", *(["carried"] if carry else []), "block", "slot", "place", "on_target")
