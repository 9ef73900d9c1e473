"""Phrase collocations by sorting suffix pointers.

A suffix is the words from a place to the end of its piece, `depth` at most. Words are
64-bit hashes of language and word, checked for collisions against the words
themselves, so equal numbers are equal words.

Three passes read the texts. The first counts words. The second sends the leading two
words of suffixes to partitions of their own, by hash, after equal ones of a
task have been added up, and keeps the pairs that are frequent. The third takes the
suffixes that begin with such a pair, and routes them by ranges of their leading words, so that a
pair with many continuations is spread over many ranges.

In a partition, suffix pointers are sorted by multikey quicksort: pointers are divided
by their word at a depth into those below, equal to and above a pivot's; the first and
last part are divided again, the equal part goes one word deeper. The size of an equal
part is the count of the phrase that its pointers share. A part with fewer pointers than
the least count holds no frequent phrase and is abandoned at once. All parts of a partition are
divided in the same numpy steps. Parts at the ends of a range, which may go on in the next one,
are kept whatever their size, and added up afterwards.

A filter of fixed size tells the second pass which words, and the third which pairs, are
infrequent; when data outgrow it, it lets more through, and the sort abandons them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import modest_batches, shared_dir, staged, unstage
from .shingles import U, Shingler, mixed

#: The longest phrase, and the marks between pieces.
DEPTH = 4
MARKS = b".,;:!?\n\x0b\x0c\r"
#: Bits of a filter, and words that a task holds before it hands on what it counted.
BITS, HELD = 26, 1 << 20
#: Suffixes of a range, about.
ROWS = 1 << 20


class Words(Shingler):
    """The words of texts as hashes, the piece of each, and where they stand."""

    table = bytes.maketrans(MARKS + b"\t", b"\n" * len(MARKS) + b" ")

    def read(self, texts: list[bytes], salts: np.ndarray) -> tuple[np.ndarray, ...]:
        """(hash, text, piece, start, end) of each word, and the bytes they stand in.
        salts, one for each text, make the words of languages differ."""
        data = np.frombuffer((b"\n" + b"\n".join(texts) + b"\n").lower().translate(self.table), np.uint8)
        self._grow(len(data))
        mark = data == 10
        edge = np.diff((mark | (data == 32)).view(np.int8))
        starts, ends = np.flatnonzero(edge == -1) + 1, np.flatnonzero(edge == 1) + 1
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.of_byte[data] * self.powers[: len(data)], out=total[1:])
        text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts)
        hashes = mixed(((total[ends] - total[starts]) * self.inverses[starts]) ^ salts[text]).view(np.int64)
        hashes[hashes == 0] = 1  # zero is no word
        return hashes, text, np.cumsum(mark)[starts], starts, ends, data


def slices(texts: Iterable[bytes], size: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """The texts, long ones cut at marks, with their numbers. A stretch without a mark
    is never cut."""
    for k, t in enumerate(texts):
        at = 0
        while len(t) - at > 2 * size:
            cut = max(t.rfind(bytes([m]), at, at + size) for m in MARKS)
            if cut < 0:
                found = [x for m in MARKS if (x := t.find(bytes([m]), at + size)) >= 0]
                cut = min(found, default=len(t) - 1)
            yield k, t[at : cut + 1]
            at = cut + 1
        yield k, t[at:]


def _salt(lang: str, seed: int) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8, key=b"%d" % seed).digest(), "little")


def _read(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[tuple]:
    """The words of batches (text, lang), about HELD at a time, as Words.read gives
    them, and the languages of the texts."""
    words, salts = Words(seed=seed), {}
    group: list[tuple[bytes, str]] = []

    def flush():
        langs = [lang for _, lang in group]
        for lang in set(langs) - set(salts):
            salts[lang] = _salt(lang, seed)
        out = words.read([t for t, _ in group], np.array([salts[lang] for lang in langs], np.uint64))
        group.clear()
        return out, langs

    held = 0
    for b in batches:
        langs = b.column(1).to_pylist()
        texts = (x.as_buffer().to_pybytes() if x.is_valid else b"" for x in b.column(0))
        for k, t in slices(texts):
            group.append((t, langs[k] if langs[k] is not None else "und"))
            held += len(t)
            if held >= 6 * HELD:
                yield flush()
                held = 0
    if group:
        yield flush()


def _word_counts(seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (hashes, text, _, starts, ends, data), langs in _read(batches, seed):
            keys, first, counts = np.unique(hashes, return_index=True, return_counts=True)
            raw = data.tobytes()
            spelled = [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
            own = [langs[t] for t in text[first].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(own, pa.string()), pa.array(spelled, pa.string()), pa.array(counts.astype(np.int64))], ["w", "lang", "word", "n"])

    return run


def slot_of(words: np.ndarray) -> np.ndarray:
    """The place in a filter of rows of words."""
    x = np.zeros(len(words), np.uint64)
    for k in range(words.shape[1]):
        x = mixed(x * U(0x9E3779B97F4A7C15) + words[:, k].view(np.uint64))
    return (x >> U(64 - BITS)).astype(np.int64)


def _filter_bits(keys: DataFrame, columns: list[str]) -> np.ndarray:
    """A bit map, of 2^BITS bits at any size of the input, of the slots of the rows of keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(1 << (BITS - 6), np.uint64)
        for b in batches:
            slots = slot_of(np.column_stack([c.to_numpy() for c in b.columns]))
            np.bitwise_or.at(held, slots >> 6, U(1) << (slots & 63).astype(np.uint64))
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at].view(np.int64))], ["at", "bits"])

    found = keys.select(*columns).mapInArrow(run, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    # at most 2^(BITS - 6) rows, whatever the input
    rows = found.toArrow()
    bits = np.zeros(1 << (BITS - 6), np.uint64)
    bits[rows["at"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return bits


def _holds(bits: np.ndarray, words: np.ndarray) -> np.ndarray:
    slots = slot_of(words)
    return (bits[slots >> 6] >> (slots & 63).astype(np.uint64)) & U(1) == 1


def suffixes(hashes: np.ndarray, piece: np.ndarray, frequent: np.ndarray, depth: int) -> np.ndarray:
    """For each word the suffix that it begins: rows of `depth` hashes, 0 where a piece ends
    or an infrequent word stands, which no frequent phrase can hold."""
    out = np.zeros((len(hashes), depth), np.int64)
    alive = frequent
    for k in range(depth):
        n = len(hashes) - k
        if n <= 0:
            break
        if k:
            alive = alive[:n] & frequent[k:] & (piece[:n] == piece[k:])
        out[:n, k] = np.where(alive, hashes[k:], 0)
    return out


def _added_up(rows: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows in order, and how often each occurs."""
    order = np.lexsort(rows.T[::-1])
    rows = rows[order]
    first = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)])) if len(rows) else np.zeros(0, np.int64)
    weights = np.ones(len(rows), np.int64) if weights is None else weights[order]
    return rows[first], np.add.reduceat(weights, first) if len(first) else weights


def _suffix_rows(seed: int, depth: int, words, pairs):
    """Suffixes of `depth` words at most, with how often a task's share of the texts has each;
    those whose first word, or pair of words, a filter doesn't hold are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f"w{k + 1}" for k in range(depth)] + ["n"]
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out() -> pa.RecordBatch:
            rows, n = _added_up(np.concatenate([r for r, _ in held]), np.concatenate([n for _, n in held]))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[:, k])) for k in range(depth)] + [pa.array(n)], names)

        for (hashes, _, piece, *_), _ in _read(batches, seed):
            rows = suffixes(hashes, piece, _holds(words.value, hashes[:, None]), depth)
            rows = rows[rows[:, 1] != 0]
            if pairs is not None:
                rows = rows[rows[:, 2] != 0]
                rows = rows[_holds(pairs.value, rows[:, :2])]
                rows = rows[_holds(pairs.value, rows[:, 1:3])]
                ends = (rows[:, 3] != 0) & ~_holds(pairs.value, rows[:, 2:4])
                rows[ends, 3] = 0
            held.append(_added_up(rows))
            if sum(len(r) for r, _ in held) >= 2 * HELD:
                yield out()
        if held:
            yield out()

    return run


def quicksort_counts(rows: np.ndarray, weights: np.ndarray, least: int, skip: int = 0, open_ends: bool = False) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Multikey three-way quicksort of pointers to rows (0 ends a row), all parts of a
    round in the same steps: for each length, (length, pointers to rows that begin with
    the phrases found, their counts, whether they are at an end).

    Parts lighter than least are abandoned; with open_ends, not those that hold the
    least or the greatest row. Phrases of `skip` words or fewer are not reported."""
    if not len(rows):
        return []
    depth = rows.shape[1]
    pointers, part = np.arange(len(rows)), np.zeros(len(rows), np.int64)
    at = np.zeros(1, np.int64)  # the depth of each part
    ends = np.array([[True, True]]) if open_ends else np.zeros((1, 2), bool)
    found = []
    while len(pointers):
        begins = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        sizes = np.diff(np.append(begins, len(part)))
        word = rows[pointers, at[part]]
        # the pivot: the middle one of three words of the part
        three = np.stack([word[begins], word[begins + sizes // 2], word[begins + sizes - 1]])
        pivot = np.sort(three, axis=0)[1]
        side = 1 + (word > pivot[part]).astype(np.int64) - (word < pivot[part])
        group = part * 3 + side
        n = 3 * len(at)
        counts = np.bincount(group, minlength=n)
        first = np.cumsum(counts) - counts
        sided = counts.reshape(-1, 3)
        earlier = np.cumsum(sided, axis=0) - sided
        moved = np.empty_like(pointers)
        for s in range(3):
            own = np.flatnonzero(side == s)
            moved[first[group[own]] + np.arange(len(own)) - earlier[part[own], s]] = pointers[own]
        heavy = np.bincount(group, weights[pointers], n)
        pointers, group = moved, np.repeat(np.arange(n), counts)
        exists = counts > 0
        kinds, parents = np.arange(n) % 3, np.arange(n) // 3
        # which new parts hold the least and the greatest rows
        lowest, highest = (sided > 0).argmax(axis=1), 2 - (sided[:, ::-1] > 0).argmax(axis=1)
        edge = np.stack([ends[parents, 0] & (kinds == lowest[parents]), ends[parents, 1] & (kinds == highest[parents])], axis=1)
        keep = exists & ((heavy >= least) | edge.any(axis=1))
        equal = kinds == 1
        words_so_far = at[parents] + 1
        ended = equal & (pivot[parents] == 0)
        keep &= ~ended
        for length in range(skip + 1, depth + 1):
            hit = np.flatnonzero(keep & equal & (words_so_far == length))
            if len(hit):
                found.append((length, pointers[first[hit]], heavy[hit].astype(np.int64), edge[hit].any(axis=1)))
        keep &= ~(equal & (words_so_far == depth))
        numbers = np.cumsum(keep) - 1
        stay = keep[group]
        pointers, part = pointers[stay], numbers[group[stay]]
        at, ends = (at[parents] + equal)[keep], edge[keep]
    return found


def _counts(depth: int, least: int, skip: int, open_ends: bool):
    """The phrases of a partition of suffix rows: their words, and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for b in batches:
            columns = [c.to_numpy() for c in b.columns]
            held.append((np.column_stack(columns[:depth]), columns[depth]))
            if len(held) > 1 and sum(len(r) for r, _ in held[1:]) > 2 * ROWS:
                # equal rows of many tasks
                held = [_added_up(np.concatenate([r for r, _ in held]), np.concatenate([n for _, n in held]))]
        if not held:
            return
        rows, n = np.concatenate([r for r, _ in held]), np.concatenate([n for _, n in held])
        held.clear()
        for length, pointers, counts, edge in quicksort_counts(rows, n, least, skip, open_ends):
            words = rows[pointers, :length]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(words) + 1, dtype=np.int32) * length), pa.array(words.ravel()))
            yield pa.RecordBatch.from_arrays([lists, pa.array(counts), pa.array(edge)], ["phrase", "a", "edge"])

    return run


def word_table(texts: DataFrame, tries: int = 8) -> tuple[DataFrame, int]:
    """Staged (w, lang, word, f) of all words of texts (text, lang), and the seed of their hashes, the
    first for which no two words share one."""
    for seed in range(tries):
        counted = texts.mapInArrow(_word_counts(seed), "w long, lang string, word string, n long")
        own = F.struct("lang", "word")
        words = counted.groupBy("w").agg(F.min(own).alias("own"), F.max(own).alias("other"), F.sum("n").alias("f"))
        words = staged(words.select("w", "own.lang", "own.word", "f", (F.col("own") != F.col("other")).alias("clash")))
        if words.where("clash").isEmpty():
            return words.drop("clash"), seed
        unstage(words)
    raise ValueError("the hashes of words collide for every seed")


def phrase_counts(texts: DataFrame, words: DataFrame, seed: int, least: int) -> DataFrame:
    """Staged (phrase array<long>, a): the phrases of 2 to DEPTH words that occur least times or more."""
    spark = texts.sparkSession
    share = spark.sparkContext.broadcast
    frequent = share(_filter_bits(words.where(F.col("f") >= least), ["w"]))
    pair_rows = texts.mapInArrow(_suffix_rows(seed, 2, frequent, None), "w1 long, w2 long, n long")
    total = words.agg(F.coalesce(F.sum(F.when(F.col("f") >= least, F.col("f"))), F.lit(0))).first()[0]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // ROWS))
    shape = "phrase array<long>, a long, edge boolean"
    pairs = staged(pair_rows.repartition(parts, "w1", "w2").mapInArrow(_counts(2, least, 1, False), shape))
    names = [f"w{k + 1}" for k in range(DEPTH)]
    bits = share(_filter_bits(pairs.select(F.col("phrase")[0].alias("w1"), F.col("phrase")[1].alias("w2")), ["w1", "w2"]))
    long_rows = staged(texts.mapInArrow(_suffix_rows(seed, DEPTH, frequent, bits), ", ".join(f"{n} long" for n in [*names, "n"])))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-long_rows.count() // ROWS))
    routed = long_rows.repartitionByRange(parts, *names)
    found = routed.mapInArrow(_counts(DEPTH, least, 2, True), shape)
    # a phrase inside a range is complete; those at the ends of ranges are added up
    whole = found.groupBy("phrase").agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    out = staged(pairs.select("phrase", "a").unionByName(whole))
    unstage(pairs, long_rows)
    return out


def _sub(start: int | Column, size: int | Column) -> Column:
    return F.slice("phrase", start, size)


def _looked_up(parts: DataFrame, known: DataFrame) -> DataFrame:
    """parts (key, ...) with the value that known (key, value, hot) has for each key. Rows
    of known that are hot, few by their making, are broadcast; so no key that many
    parts ask for is dealt to one task."""
    few = known.where("hot").select(F.col("key").alias("_k"), F.col("value").alias("_v"))
    near = parts.join(F.broadcast(few), F.col("key") == F.col("_k"), "left").drop("_k")
    rest = known.where("NOT hot").select("key", "value")
    return near.where("_v IS NOT NULL").withColumnRenamed("_v", "value").unionByName(near.where("_v IS NULL").drop("_v").join(rest, "key"))


def collocations(docs: DataFrame, least: int = 30, inside: int = 80, top: int = 2000) -> DataFrame:
    """The collocations of each language of docs (text, lang): lang, rank (from 1), phrase,
    a, l, r, n and score, the first `top` of each.

    Texts are lower-cased (A-Z), cut into pieces at . , ; : ! ? and the characters 0A to 0D, and pieces into words at
    spaces and tabs. Candidates are the phrases of 2 to 4 words that occur a >= least
    times within pieces, overlaps included. Of the ways to cut one in two, whose parts occur l and r
    times, the one with the least score floor(2000000 a / (l + r)) counts, the shortest
    first part of equal ones. A candidate goes if a longer one that holds its words side by side
    has at least `inside` percent of its count. n is the number of words of the language.
    Order: score and a descending, then phrase by its UTF-8 bytes.

    A null text has no words; a null lang is `und`. Repeated rows count as often as
    they stand; ids and other columns, whatever their names, are ignored. A text without words, or an
    empty table, gives no rows."""
    spark = docs.sparkSession
    modest_batches(spark)
    shared_dir(spark)
    texts = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    words, seed = word_table(texts)
    phrases = phrase_counts(texts, words, seed, least)
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    known = words.where(F.col("f") >= least)

    # the counts of both parts of each cut
    cuts = phrases.select("phrase", "a", F.explode(F.sequence(F.lit(1), F.size("phrase") - 1)).alias("k"))
    sides = cuts.select("phrase", "a", "k", F.explode(F.array(F.struct(F.lit(True).alias("first"), _sub(1, F.col("k")).alias("key")), F.struct(F.lit(False).alias("first"), _sub(F.col("k") + 1, F.size("phrase") - F.col("k")).alias("key")))).alias("x"))
    sides = sides.select("phrase", "a", "k", "x.first", "x.key")
    # phrases that make up a ten-thousandth of all words: at most 10000 of each length
    total = words.agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]
    hot = F.col("f") >= max(least, total // 10_000)
    counts = known.select(F.array("w").alias("key"), "f").unionByName(phrases.select(F.col("phrase").alias("key"), F.col("a").alias("f")))
    joined = _looked_up(sides, counts.select("key", F.col("f").alias("value"), hot.alias("hot")))
    both = joined.groupBy("phrase", "a", "k").agg(F.max(F.when(F.col("first"), F.col("value"))).alias("l"), F.max(F.when(~F.col("first"), F.col("value"))).alias("r"))
    score = F.expr("(CAST(a AS DECIMAL(20, 0)) * 2000000BD) div (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))")
    cut = both.withColumn("score", score.cast("long")).groupBy("phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))

    # those inside a longer candidate
    spans = [(s, n) for n in range(2, DEPTH) for s in range(1, DEPTH + 2 - n)]
    held = F.array(*[F.when(F.lit(n) < F.size("phrase"), F.when(F.lit(s + n - 1) <= F.size("phrase"), _sub(s, n))) for s, n in spans])
    covers = phrases.where(F.size("phrase") > 2).select(F.explode(F.filter(held, lambda x: x.isNotNull())).alias("phrase"), "a")
    covers = covers.groupBy("phrase").agg(F.max("a").alias("longer"))
    kept = cut.join(covers, "phrase", "left").where(F.col("longer").isNull() | (100 * F.col("longer").cast("decimal(20,0)") < inside * F.col("a").cast("decimal(20,0)")))
    kept = kept.select("phrase", "a", "c.l", "c.r", "c.score")

    # the language stands in the words; then the words themselves
    langs = known.select(F.array("w").alias("key"), F.col("lang").alias("value"), hot.alias("hot"))
    named = _looked_up(kept.withColumn("key", _sub(1, 1)), langs).withColumnRenamed("value", "lang").drop("key")
    return _top(named, known, sizes, top)


def _top(named: DataFrame, known: DataFrame, sizes: DataFrame, top: int) -> DataFrame:
    by_score = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    best = named.withColumn("_r", F.rank().over(by_score)).where(F.col("_r") <= top).drop("_r")
    placed = best.select("*", F.posexplode("phrase").alias("place", "w")).join(known.select("w", "word"), "w")
    spelled = placed.groupBy("phrase", "lang", "a", "l", "r", "score").agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("ws"))
    spelled = spelled.withColumn("phrase", F.array_join("ws.word", " ")).drop("ws")
    by_all = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = spelled.withColumn("rank", F.row_number().over(by_all)).where(F.col("rank") <= top)
    out = ranked.join(sizes, "lang")
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

