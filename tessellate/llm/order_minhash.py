"""Fingerprints of documents by order MinHash.

A text's k-mers are its runs of k words, each numbered by how often it has occurred
before. Their hashes deal them out over `bins`; in each bin the `keep` least are
selected, put back into the order of the text, and hashed as a tuple. Two texts agree
in a bin if they selected the same k-mers there in the same order, so the share of
agreeing bins falls with edit distance, moved passages included.

All of it is array expressions over a row, and two windows over ranges of doc_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import WHITE, chunk_of

#: A k-mer and its place share a long: the hash above, the place in these low bits,
#: as many as the words of the longest string that Spark can hold.
PLACE = 30


def _hash_of(x: Column) -> Column:
    return F.shiftrightunsigned(x, PLACE)


def _packed(h: Column, i: Column) -> Column:
    return F.shiftleft(F.shiftrightunsigned(h, PLACE), PLACE).bitwiseOR(i.cast("long"))


def with_signature(df: DataFrame, text: str, out: str, k: int = 3, bins: int = 32, keep: int = 2) -> DataFrame:
    """Adds `out`, an array of a long for each bin that the column `text` fills: the
    bin's number in the high bits, the hash of its tuple below.

    Each step is a column of its own, so that Spark works it out once. Sorting is on
    plain longs, which pack a 34-bit hash and a place below 2^30."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    bare = F.btrim(F.col(text), F.lit(WHITE))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))
    df = df.select(*cols, F.transform(words, lambda w: F.xxhash64(w)).alias("_w"))
    # a text of fewer than k words is one k-mer
    count = F.greatest(F.size("_w") - (k - 1), F.least(F.size("_w"), F.lit(1)))
    kmer = lambda x, i: F.xxhash64(x, *[F.get(F.col("_w"), i + j) for j in range(1, k)])
    grams = F.transform(F.slice("_w", F.lit(1), count), lambda x, i: _packed(kmer(x, i), i))
    df = df.select(*cols, F.sort_array(grams).alias("_g"))

    def first_of_run(h: Column, p: Column) -> Column:
        """Where the run of equal hashes that p stands in begins, by binary search.
        _g is sorted as signed numbers, whose order arithmetic shifts keep."""
        middle = lambda s: F.shiftright(s["lo"] + s["hi"], 1)
        found = F.aggregate(
            F.sequence(F.lit(1), F.lit(PLACE)),
            F.struct(F.lit(0).alias("lo"), p.alias("hi")),
            lambda s, _: F.when(s["lo"] >= s["hi"], s).otherwise(
                F.when(F.shiftright(F.get(F.col("_g"), middle(s)), PLACE) < F.shiftright(h, PLACE), F.struct((middle(s) + 1).alias("lo"), s["hi"].alias("hi"))).otherwise(
                    F.struct(s["lo"].alias("lo"), middle(s).alias("hi"))
                )
            ),
        )
        return found["lo"]

    def numbered(x: Column, p: Column) -> Column:
        repeats = (p > 0) & (_hash_of(F.get(F.col("_g"), p - 1)) == _hash_of(x))
        u = F.xxhash64(_hash_of(x), F.when(repeats, p - first_of_run(x, p)).otherwise(0))
        return _packed(u, x.bitwiseAND(F.lit((1 << PLACE) - 1)))

    # sorted by hash, the k-mers of a bin (the hash's high bits) stand together
    df = df.select(*cols, F.sort_array(F.transform("_g", numbered)).alias("_u"))
    shift = 64 - (bins - 1).bit_length()
    slot = lambda x: F.shiftrightunsigned(x, shift)
    least = F.filter("_u", lambda x, p: (p < keep) | (slot(F.get(F.col("_u"), p - keep)) != slot(x)))
    df = df.select(*cols, least.alias("_s"))

    def tuple_hash(x: Column, p: Column) -> Column:
        own = F.filter(F.slice(F.col("_s"), p + 1, F.lit(keep)), lambda y: slot(y) == slot(x))
        in_text = F.sort_array(F.transform(own, lambda y: F.shiftleft(y, 64 - PLACE - 1).bitwiseAND(F.lit((1 << 63) - 1)).bitwiseOR(_hash_of(y).bitwiseAND(F.lit((1 << (64 - PLACE - 1)) - 1)))))
        hashes = F.transform(in_text, lambda y: y.bitwiseAND(F.lit((1 << (64 - PLACE - 1)) - 1)))
        value = F.shiftleft(slot(x), shift).bitwiseOR(F.shiftrightunsigned(F.xxhash64(hashes), 64 - shift))
        begins = (p == 0) | (slot(F.get(F.col("_s"), p - 1)) != slot(x))
        return F.when(begins, value)

    return df.select(*cols, F.filter(F.transform("_s", tuple_hash), lambda x: x.isNotNull()).alias(out))


def likeness(a: str, b: str, bins: int = 32) -> Column:
    """The share of bins that agree, of those that either text fills; two texts
    without words are alike."""
    shift = 64 - (bins - 1).bit_length()
    filled = F.size(F.array_distinct(F.transform(F.concat(a, b), lambda x: F.shiftrightunsigned(x, shift))))
    return F.when(filled == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / filled)


def printed(signature: str) -> Column:
    """A signature as text: 16 hexadecimal digits for each bin filled."""
    return F.array_join(F.transform(signature, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def fingerprints(docs: DataFrame, k: int = 3, bins: int = 32, keep: int = 2) -> DataFrame:
    """A row for each row of docs (doc_id, text): doc_id, n_chars, the fingerprint of
    its text and of its edited text, and their likeness. The edited text has its last
    floor(n_chars / 4) code points replaced by as many first ones of the next
    document's, or all of it if it is shorter; the next is by ascending doc_id (ties
    by text), and after the last comes the first. near_next is the likeness to the
    next document's own fingerprint.

    Null text is empty. Words are what ASCII white space separates, so texts that
    differ in white space alone have equal fingerprints; a text without words has no
    k-mers and is like another such text only. Rows without doc_id come first. A
    single document is its own next. An empty table gives an empty result; other
    columns, whatever their names, are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ranged = chunk_of(rows, "doc_id")
    order = [F.col("doc_id").asc_nulls_first(), F.col("text")]
    inside = Window.partitionBy("chunk").orderBy(*order)
    # the first document of each range, as the next of the last one before it
    firsts = ranged.groupBy("chunk").agg(F.min_by("text", F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))), "text")).alias("first_text"))
    wrap = Window.orderBy("chunk")
    every = Window.partitionBy()
    firsts = firsts.select("chunk", "first_text")
    numbers = firsts.select("chunk").withColumn("after", F.coalesce(F.lead("chunk").over(wrap), F.min("chunk").over(every)))
    begins = with_signature(firsts, "first_text", "first_sig", k, bins, keep).withColumnRenamed("chunk", "after")
    border = numbers.join(begins, "after").select(F.col("chunk").alias("_chunk"), "first_text", "first_sig")

    own = with_signature(ranged, "text", "sig", k, bins, keep)
    own = own.withColumn("next_text", F.lead("text").over(inside)).withColumn("next_sig", F.lead("sig").over(inside))
    joined = own.join(border, F.col("chunk") == F.col("_chunk"))
    size = F.char_length("text")
    cut = F.floor(size / 4).cast("int")
    joined = joined.select(
        "doc_id",
        size.cast("long").alias("n_chars"),
        "sig",
        F.coalesce("next_sig", "first_sig").alias("next_sig"),
        F.concat(F.substring("text", F.lit(1), size - cut), F.substring(F.coalesce("next_text", "first_text"), F.lit(1), cut)).alias("edited"),
    )
    both = with_signature(joined, "edited", "edited_sig", k, bins, keep)
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        printed("sig").alias("fingerprint"),
        printed("edited_sig").alias("edited_fingerprint"),
        likeness("sig", "edited_sig", bins).alias("near_edited"),
        likeness("sig", "next_sig", bins).alias("near_next"),
    )
