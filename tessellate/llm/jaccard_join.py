"""Similarity join of documents on the Jaccard similarity of their word n-grams.

A size-aware heavy-light join. Sets of up to `boundary` grams are light: two of
them of sizes a and b are similar if they share a subset of the least overlap
that these sizes need, so each enumerates its subsets of that fixed size, and
equal subsets meet in a hash join without further proof. Larger sets are heavy:
they scan the inverted lists of the grams at the head of their order, and what
meets there is verified on whole sets. The boundary is the largest size for which
the subsets of a set cost less than the list entries it would read and the
comparisons they lead to, by the share of entries in the corpus that are shared.

Equal sets are one class before anything is joined. In a list or under a subset,
members are linked through one of them, never in all pairs; what a pivot leaves
apart is compared in a second pass, between different components only.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bucketed, free_shuffles, modest_batches, staged, unstage
from .components import components
from .set_links import count_links
from .shingles import Shingler, U, mixed

#: Powers of two that bound the bits of the sketch of shared grams, 8 to 128 MB, which
#: is broadcast; that of heavy ones, which are few, has the least.
SKETCH_BITS = 26, 30
#: Bits of a gram's hash that are counted: chance collisions among 32 bits would already
#: make a third of the grams of 4 GB of texts look shared.
COUNTED = 40
#: What comparing two sets costs beside their grams, in rows of a shuffle.
COMPARISON = 10
#: Members of a list that one task compares with others at a time.
CELL = 4096


def least_overlap(a: int, b: int, percent: int) -> int:
    """The smallest overlap with which sets of sizes a and b are similar:
    100 * overlap >= percent * (a + b - overlap)."""
    return -(-percent * (a + b) // (100 + percent))


def partner_sizes(a: int, percent: int) -> range:
    return range(-(-percent * a // 100), 100 * a // percent + 1)


def subset_count(a: int, percent: int) -> int:
    return sum(math.comb(a, least_overlap(a, b, percent)) for b in partner_sizes(a, percent))


def prefix_length(a: int, percent: int) -> int:
    """As many grams, first in any order common to all sets, that a similar set
    must hold one of them."""
    return a - -(-percent * a // 100) + 1


def _packed(values: np.ndarray, slices: int) -> bytes:
    """Sorted numbers of one slice of the 40-bit ones, in about three bytes each: how many
    have each upper 16 bits that the slice has, and the other bits."""
    halves = max(1, 65536 // slices)
    upper = np.bincount((values >> U(24)).astype(np.int64) % halves, minlength=halves)
    return upper.astype("<u4").tobytes() + (values & U(0xFFFF)).astype("<u2").tobytes() + (values >> U(16)).astype(np.uint8).tobytes()


def _unpacked(data: bytes, k: int, slices: int) -> np.ndarray:
    halves = max(1, 65536 // slices)
    upper = np.repeat(np.arange(halves, dtype=np.uint64) + U(k * 65536 // slices), np.frombuffer(data, "<u4", halves))
    lower = np.frombuffer(data, "<u2", len(upper), 4 * halves).astype(np.uint64)
    middle = np.frombuffer(data, np.uint8, len(upper), 4 * halves + 2 * len(upper)).astype(np.uint64)
    return upper << U(24) | middle << U(16) | lower


def _counts(width: int, slices: int):
    """The upper 40 bits of the even grams of all texts, sorted, by slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, held, size = Shingler(width), [], 0
        shift = COUNTED - slices.bit_length() + 1

        def flush() -> pa.RecordBatch:
            every = np.sort(np.concatenate(held))
            edges = np.searchsorted(every, np.arange(slices + 1, dtype=np.uint64) << U(shift))
            full = [k for k in range(slices) if edges[k] < edges[k + 1]]
            return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([_packed(every[edges[k] : edges[k + 1]], slices) for k in full], pa.binary())], ["slice", "hashes"])

        for b in batches:
            for grams in shingler.of_column(b.column(0)):
                own = grams[(grams & U(1)) == 0] >> U(64 - COUNTED)
                held.append(own)
                size += len(own)
                if size > 1 << 20:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    return run


def _sketch(slices: int, heavy: int, bits: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        k = int(pdf["slice"].iloc[0])
        every = np.sort(np.concatenate([_unpacked(x, k, slices) for x in pdf["hashes"]]))
        first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
        times = np.diff(np.r_[first, len(every)])
        maps = []
        for least, size in ((2, bits), (heavy, SKETCH_BITS[0])):
            part = (1 << size) // slices
            marks = np.zeros(part, np.uint8)
            marks[(every[first[times >= least]] >> U(COUNTED - size)).astype(np.int64) - k * part] = 1
            maps.append(zlib.compress(np.packbits(marks).tobytes(), 1))
        return pd.DataFrame({"slice": [k], "shared": [maps[0]], "heavy": [maps[1]], "f": [float(times[times > 1].sum())], "all": [float(times.sum())]})

    return run


def sketch_bits(size: int) -> int:
    """The power of two that leaves the sketch of shared grams sparse for texts of so
    many bytes: half a bit or more for each gram that is counted."""
    return min(SKETCH_BITS[1], max(SKETCH_BITS[0], (size // 26).bit_length()))


def list_sketch(docs: DataFrame, width: int, heavy: int = 64) -> tuple[bytes, bytes, float]:
    """Bit maps, by the hash of an even gram, of those that two or more and that
    `heavy` or more rows hold, counted over all rows, and the share of all entries
    that are of shared grams. The maps' size follows the texts', within bounds."""
    wanted = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = min(1 << 20, max(64, 1 << (wanted - 1).bit_length()))
    bits = sketch_bits(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    counted = docs.select("text").mapInArrow(_counts(width, slices), "slice int, hashes binary")
    found = counted.groupBy("slice").applyInPandas(_sketch(slices, heavy, bits), "slice int, shared binary, heavy binary, f double, all double").collect()
    maps = [bytearray(1 << (size - 3)) for size in (bits, SKETCH_BITS[0])]
    for r in found:
        for m, part in zip(maps, (r["shared"], r["heavy"]), strict=True):
            step = len(m) // slices
            m[r["slice"] * step : (r["slice"] + 1) * step] = zlib.decompress(part)
    total = sum(r["all"] for r in found)
    return bytes(maps[0]), bytes(maps[1]), sum(r["f"] for r in found) / total if total else 0.0


def choose_boundary(shared: float, percent: int) -> int:
    """The largest size at which the subsets of a set cost no more than its entries
    in lists, each a row, and for the shared ones a comparison with a pivot."""
    a = 1
    # subsets grow faster than any of the costs beside them, and at 100 percent both stay even
    while subset_count(a, percent) <= prefix_length(a, percent) * (1 + shared * (COMPARISON + a)) and a < 255:
        a += 1
    return a - 1


def _subset_keys(grams: np.ndarray, boundary: int, percent: int) -> list[int]:
    """A key for each subset and pair of sizes; the last bit is set for the larger
    set of a pair of unequal sizes."""
    a = len(grams)
    salted: dict[int, np.ndarray] = {}
    keys: list[np.ndarray] = []
    for b in partner_sizes(a, percent):
        if b > boundary:
            continue
        c = least_overlap(a, b, percent)
        if c not in salted:
            index = np.array(list(combinations(range(a), c)), np.int64)
            salted[c] = mixed(grams * U(0x9E3779B97F4A7C15))[index].sum(axis=1, dtype=np.uint64)
        pair = U((min(a, b) << 8 | max(a, b)) * 0x51ED27)
        keys.append((mixed(salted[c] + pair) & ~U(1)) | U(a > b))
    return np.concatenate(keys).astype(np.uint64).view(np.int64).tolist() if keys else []


def _parities(grams: np.ndarray) -> np.ndarray:
    """512 bits, each the parity of the number of grams that fall on it. Two sets
    differ in at least as many grams as these differ in bits."""
    odd = np.bincount(((grams >> U(20)) & U(511)).astype(np.int64), minlength=512) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


def _entries(width: int, percent: int, boundary: int, maps):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        shared, heavy = (np.frombuffer(m, np.uint8) for m in maps.value)

        def is_set(bits: np.ndarray, grams: np.ndarray) -> np.ndarray:
            place = (grams >> U(65 - (8 * len(bits)).bit_length())).astype(np.int64)
            return (bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1

        for b in batches:
            sizes, prints, heads, subsets, centres, sketches = [], [], [], [], [], []
            for grams in shingler.of_column(b.column(1)):
                n = len(grams)
                sizes.append(n)
                prints.append(int(mixed(grams ^ U(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)) if n else 0)
                subsets.append(_subset_keys(grams, boundary, percent) if 0 < n <= boundary else [])
                if n and 100 * n // percent > boundary:
                    counted = (grams & U(1)) == 0
                    order = np.where(counted, is_set(shared, grams) + 2 * is_set(heavy, grams), 2).astype(np.uint64)
                    head = np.sort(order << U(62) | grams >> U(2))[: prefix_length(n, percent)]
                    heads.append(_signed(head[head >> U(62) > 0]).tolist())
                    centres.append(float(np.mean(order[counted])) if counted.any() else 0.0)
                    sketches.append(_parities(grams))
                else:
                    heads.append([])
                    centres.append(0.0)
                    sketches.append(None)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(sizes, pa.int64()), pa.array(prints, pa.int64()), pa.array(heads, longs), pa.array(subsets, longs), pa.array(centres, pa.float64()), pa.array(sketches, longs)],
                ["doc_id", "n", "fp", "head", "subsets", "centre", "sketch"],
            )

    return run


def _wanted_sets(width: int, ids):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, bits = Shingler(width), np.frombuffer(ids.value, np.uint8)
        for b in batches:
            place = b.column(2).to_numpy(zero_copy_only=False)
            keep = pa.array(((bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1).astype(bool))
            b = b.filter(keep)
            if not b.num_rows:
                continue
            sets = list(shingler.of_column(b.column(1)))
            prints = [int(mixed(g ^ U(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)) for g in sets]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prints, pa.int64()), pa.array([_signed(g) for g in sets], pa.list_(pa.int64()))], ["doc_id", "fp", "grams"])

    return run


def id_filter(ids: DataFrame, bits: int = 24) -> bytes:
    """A bit map, of fixed size, of the hashed values of the column doc_id. Tasks make
    it in parts of 1 KB, which are all that the driver gets."""

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        part = np.zeros(1 << 13, np.uint8)
        part[pdf["bit"].to_numpy()] = 1
        return pd.DataFrame({"part": pdf["part"].iloc[:1], "map": [np.packbits(part).tobytes()]})

    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << bits))
    marks = ids.select(F.shiftright(place, 13).alias("part"), place.bitwiseAND(F.lit((1 << 13) - 1)).alias("bit")).distinct()
    out = bytearray(1 << (bits - 3))
    for r in marks.groupBy("part").applyInPandas(packed, "part long, map binary").toLocalIterator():
        out[r["part"] << 10 : (r["part"] + 1) << 10] = r["map"]
    return bytes(out)


def _sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return (100 * F.least(a, b)) >= (percent * F.greatest(a, b))


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of set hashes with size (the sum of both) and o, the overlap."""
    left = sets.select(F.col("fp").alias("a"), F.col("grams").alias("ga"))
    right = sets.select(F.col("fp").alias("b"), F.col("grams").alias("gb"))
    both = pairs.join(right, "b").join(left, "a")
    return both.select("a", "b", (F.size("ga") + F.size("gb")).alias("size"), F.size(F.array_intersect("ga", "gb")).alias("o"))


def _similar(percent: int) -> Column:
    return 100 * F.col("o") >= percent * (F.col("size") - F.col("o"))


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80, count: bool = True) -> DataFrame:
    """Links documents whose sets of word n-grams (of `width` words) have a Jaccard
    similarity of percent / 100 or more, without loss, and gives for each row
    doc_id, n_shingles (the size of its set), component_id (the smallest doc_id
    that links lead to, its own included) and, unless count is off, n_links (how many
    other documents are linked to it directly).

    Null, empty and blank texts have no grams and link with nothing. Rows that
    share a doc_id are one node; where their texts differ, n_links is of the row's own
    text, and counts such a node once for each of its texts that is similar. A row
    without doc_id links with nothing and has no component. An empty table gives an empty result; other columns, whatever
    their names, are ignored. Sets are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    modest_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shared, heavy, share = list_sketch(docs, width)
    maps = spark.sparkContext.broadcast((shared, heavy))
    boundary = choose_boundary(share, percent)
    entries = staged(docs.mapInArrow(_entries(width, percent, boundary, maps), "doc_id long, n long, fp long, head array<long>, subsets array<long>, centre double, sketch array<long>"))
    maps.destroy()
    known = entries.where("n > 0 AND doc_id IS NOT NULL")
    classes = staged(known.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.count_distinct("doc_id").alias("w")))
    # a row of each class that stands for it: the rest is of the set alone
    chosen = staged(known.where("size(head) > 0 OR size(subsets) > 0").select("fp", "n", "head", "subsets", "centre", "sketch").dropDuplicates(["fp"]))
    rows = staged(entries.select("doc_id", "n", "fp"))
    unstage(entries)
    free_shuffles(spark)

    # light sets: an equal subset proves a link, also between sets of the smaller
    # size of its pair, which need no larger overlap; a star on either side joins all
    keyed = chosen.select("fp", F.explode("subsets").alias("key")).select("fp", F.shiftright("key", 1).alias("key"), F.col("key").bitwiseAND(F.lit(1)).alias("side"))
    hubs = keyed.groupBy("key").agg(F.min(F.when(F.col("side") == 0, F.col("fp"))).alias("small"), F.min(F.when(F.col("side") == 1, F.col("fp"))).alias("large"), F.count(F.lit(1)).alias("m"))
    same = hubs.where("large IS NULL AND m > 1").select("key", F.lit(0).alias("side"), F.col("small").alias("hub"))
    cross = hubs.where("small IS NOT NULL AND large IS NOT NULL")
    cross = cross.select("key", F.lit(1).alias("side"), F.col("small").alias("hub")).unionAll(cross.select("key", F.lit(0).alias("side"), F.col("large").alias("hub")))
    subset_links = staged(keyed.join(same.unionAll(cross), ["key", "side"]).where("fp <> hub").select(F.col("hub").alias("a"), F.col("fp").alias("b")).distinct())

    # heavy sets: each list compares its members with the one whose grams are shared
    # most, as the original is among its edited copies
    posts = chosen.select("fp", "n", "centre", F.explode("head").alias("gram"))
    pivots = posts.groupBy("gram").agg(F.max_by(F.struct("fp", "n"), F.struct("centre", "fp")).alias("p"), F.count(F.lit(1)).alias("m")).where("m > 1").select("gram", F.col("p.fp").alias("pivot"), F.col("p.n").alias("pivot_n"))
    met = staged(posts.join(pivots, "gram").select("fp", "n", "gram", "pivot", "pivot_n"))
    near = met.where((F.col("fp") != F.col("pivot")) & _sizes_fit(F.col("n"), F.col("pivot_n"), percent)).select(F.col("pivot").alias("a"), F.col("fp").alias("b")).distinct()
    asked = met.select("fp")
    if count:
        asked = asked.unionAll(subset_links.select(F.explode(F.array("a", "b")).alias("fp")))
    asked = staged(asked.distinct().join(classes, "fp").select("fp", F.col("rep").alias("doc_id")))
    free_shuffles(spark)
    wanted = spark.sparkContext.broadcast(id_filter(asked))
    hashed = docs.where("doc_id IS NOT NULL").withColumn("place", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 24)))
    sets = hashed.mapInArrow(_wanted_sets(width, wanted), "doc_id long, fp long, grams array<long>")
    # sets are shuffled once: they are kept in buckets of fp, by which all below join them
    sets = bucketed(sets.select("fp", "grams").dropDuplicates(["fp"]).join(asked.select("fp"), "fp", "left_semi"), "fp")
    wanted.destroy()
    unstage(asked)
    free_shuffles(spark)
    compared = staged(_compared(near, sets))
    links = staged(subset_links.unionAll(compared.where(_similar(percent)).select("a", "b")))
    unstage(subset_links)
    free_shuffles(spark)

    # what is still in different components though it shares a list; Jaccard distance
    # is a metric, so two members whose distances to the list's pivot differ by more
    # than the limit can't be similar, nor can two whose parities differ too much
    from_pivot = compared.select(F.col("a").alias("pivot"), F.col("b").alias("fp"), (1 - F.col("o") / (F.col("size") - F.col("o"))).alias("d"))
    limit = 1 - percent / 100 + 1e-9
    found = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    # what is read more than once is written first: plans that repeat it are large, and
    # the driver holds them with what Spark generates for them
    placed = met.join(found, met["fp"] == found["node"], "left")
    placed = staged(placed.select("fp", "n", "gram", "pivot", F.coalesce("component", "fp").alias("comp")))
    unstage(met, found)
    free_shuffles(spark)
    by_comp = placed.groupBy("gram", "comp").agg(F.count(F.lit(1)).alias("k"))
    # a long list is dealt over cells: its members look into one each, and those of
    # other components than the main one into all
    main = by_comp.groupBy("gram").agg(F.max_by("comp", F.struct("k", "comp")).alias("main"), F.count(F.lit(1)).alias("comps"), F.sum("k").alias("k")).where("comps > 1")
    main = main.select("gram", "main", F.ceil(F.col("k") / CELL).cast("int").alias("cells"))
    apart = placed.join(main, "gram").join(from_pivot, ["pivot", "fp"], "left").join(chosen.select("fp", "sketch"), "fp")
    apart = staged(apart.select("fp", "n", "gram", "comp", "main", "cells", "sketch", F.when(F.col("fp") == F.col("pivot"), 0.0).otherwise(F.col("d")).alias("d")))
    minor = apart.where("comp <> main").withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    minor = minor.select("gram", "cell", F.col("fp").alias("x"), F.col("n").alias("xn"), F.col("comp").alias("xc"), F.col("d").alias("xd"), F.col("sketch").alias("xs"))
    other = apart.select("gram", F.pmod(F.xxhash64("fp"), "cells").cast("int").alias("cell"), F.col("fp").alias("y"), F.col("n").alias("yn"), F.col("comp").alias("yc"), F.col("d").alias("yd"), F.col("sketch").alias("ys"), (F.col("comp") == F.col("main")).alias("in_main"))
    # sets of sizes x and y with overlap o differ in x + y - 2 o grams
    differing = F.aggregate(F.zip_with("xs", "ys", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda t, k: t + k)
    room = (F.col("xn") + F.col("yn")) * (1 - 2 * percent / (100 + percent)) + 1e-6
    rest = minor.join(
        other,
        (minor["gram"] == other["gram"])
        & (minor["cell"] == other["cell"])
        & (F.col("xc") != F.col("yc"))
        & (F.col("in_main") | (F.col("x") < F.col("y")))
        & _sizes_fit(F.col("xn"), F.col("yn"), percent)
        & F.coalesce(F.abs(F.col("xd") - F.col("yd")) <= limit, F.lit(True))
        & (differing <= room),
    )
    rest = rest.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    rest = rest.join(compared.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    more = staged(_compared(rest, sets).where(_similar(percent)).select("a", "b"))
    unstage(placed, apart, compared)
    free_shuffles(spark)

    name = classes.select("fp", "rep")
    edges = links.unionAll(more).join(name.select(F.col("fp").alias("a"), F.col("rep").alias("u")), "a").join(name.select(F.col("fp").alias("b"), F.col("rep").alias("v")), "b").select("u", "v")
    final = components(edges)
    label = staged(classes.join(final, classes["rep"] == final["node"], "left").select(F.col("fp").alias("f"), "rep", "w", "component"))
    unstage(links, more, classes, final)
    columns = [F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "doc_id").alias("component_id")]
    if count:
        members = label.where("component IS NOT NULL").select(F.col("f").alias("fp"), "w", "component").join(chosen.select("fp", "n", "centre"), "fp").join(sets, "fp")
        label = label.join(count_links(members, percent).withColumnRenamed("fp", "l"), F.col("f") == F.col("l"), "left")
        columns.append((F.coalesce("w", F.lit(1)) - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    unstage(sets, chosen)
    free_shuffles(spark)
    out = rows.join(label, (F.col("fp") == F.col("f")) & (F.col("n") > 0) & F.col("doc_id").isNotNull(), "left")
    return out.select("doc_id", *columns)
