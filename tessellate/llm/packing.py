"""Packing of tokenized documents into sequences of a fixed length.

Documents are tokenized, ended with an end token, cut where they are longer than
a sequence, and the pieces packed by the sum-of-squares rule: a piece goes where
the sum, over the gaps 1 to capacity - 1, of the squared number of open sequences
with that gap becomes smallest. The rule looks at counts only, so pieces are
dealt by hash into groups of about `group_rows` and each group is packed by one
task; a group wastes a few sequences' worth at most, whatever the corpus holds.
Where the pieces have an order to keep, groups are contiguous ranges of it instead.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunk_of, modest_batches, staged

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def added_tokens(json_path: str) -> dict[str, int]:
    """The added tokens of a vocabulary's JSON form, whose strings are matched in
    texts before anything else, and their ids."""
    with open(json_path, encoding="utf-8") as f:
        added = json.load(f).get("added_tokens") or []
    for t in added:
        if t.get("lstrip") or t.get("rstrip") or t.get("single_word"):
            raise ValueError(f"added token {t['content']!r} takes in its surroundings, which isn't supported")
    return {t["content"]: int(t["id"]) for t in added}


def byte_bpe(ranks_path: str, pattern: str, added: dict[str, int]) -> Callable[[str], bytes]:
    """An encoder to little-endian unsigned 32-bit ids for a byte-level BPE
    vocabulary kept as ranks. Texts are cut at the strings of added tokens, and what
    stands between them is encoded by itself, as the JSON form does."""
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    plain = lambda text: encoding.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
    if not added:
        return plain
    cut = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")
    own = {t: np.asarray([i], "<u4").tobytes() for t, i in added.items()}

    def encode(text: str) -> bytes:
        parts = cut.split(text)
        if len(parts) == 1:
            return plain(text)
        # parts stand at even places, the added tokens between them at odd ones
        return b"".join(own[t] if k % 2 else plain(t) for k, t in enumerate(parts))

    return encode


def _pieces(vocabulary: str, end_id: int, capacity: int, with_ids: bool, order: str | None = None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        added = added_tokens(public_tokenizers.path(vocabulary.rsplit(".", 1)[0] + ".json"))
        encode = byte_bpe(public_tokenizers.path(vocabulary), public_tokenizers.PATTERN, added)
        end = np.asarray([end_id], "<u4").tobytes()
        for b in batches:
            rows: list[tuple] = []
            places: list[int | None] = []
            carried = b.column(2).to_pylist() if order else [None] * len(b)
            for doc_id, text, place in zip(b.column(0).to_pylist(), b.column(1), carried, strict=True):
                ids = encode(text.as_py() or "") + end
                n = len(ids) // 4
                edges = [*range(n % capacity or capacity, n + 1, capacity)]
                places += [place] * len(edges)
                for k, (lo, hi) in enumerate(zip([0, *edges], edges, strict=False)):
                    own = ids[4 * lo : 4 * hi]
                    rows.append((doc_id, k, lo, hi - lo, zlib.crc32(own), np.frombuffer(own, "<u4").astype("i4") if with_ids else None))
            cols = list(zip(*rows, strict=True)) or [()] * 6
            arrays = [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=False)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(cols[5], pa.list_(pa.int32())))
                names.append("ids")
            if order:
                arrays.append(pa.array(places, pa.int64()))
                names.append(order)
            yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def tokenize_pieces(docs: DataFrame, capacity: int = 1024, end_id: int = 2, vocabulary: str = "byte_bpe_50k.tiktoken", with_ids: bool = False, order: str | None = None) -> DataFrame:
    """The pieces of each document: its ids and end_id, in one piece if they fit
    and else in pieces of capacity, the first of which may be shorter.

    ids_crc32 is over the piece's ids as little-endian unsigned 32-bit numbers. A
    column of longs that order names is carried along."""
    schema = PIECES + (", ids array<int>" if with_ids else "") + (f", `{order}` long" if order else "")
    carried = [F.col(order).cast("long")] if order else []
    return docs.select(F.col("doc_id").cast("long"), "text", *carried).mapInArrow(_pieces(vocabulary, end_id, capacity, with_ids, order), schema)


def sum_of_squares(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each size, placed in the order given.

    Putting size s into a bin of gap g changes the sum of squares by
    2 (N[g-s] - N[g]) + 2, into a new bin by 2 N[capacity-s] + 1; a bin that
    becomes full leaves the sum. Among equals the tightest gap wins."""
    count = np.zeros(capacity + 1)
    count[0] = -0.5  # so that filling a bin up costs 1 - 2 N[s]
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    where = np.empty(len(sizes), np.int64)
    bins = 0
    for i, s in enumerate(sizes.tolist()):
        gap = capacity
        if s < capacity:
            now = count[s:capacity]
            cost = np.where(now > 0, count[: capacity - s] - now, np.inf)
            k = int(cost.argmin())
            if cost[k] <= count[capacity - s] - 0.5:
                gap = k + s
        if gap == capacity:
            where[i], bins = bins, bins + 1
        else:
            where[i] = open_bins[gap].pop()
            count[gap] -= 1
        if gap > s:
            open_bins[gap - s].append(int(where[i]))
            count[gap - s] += 1
    return where


def pack_sizes(sizes: np.ndarray, capacity: int, rounds: int = 8, share: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the offset in it of each size, whose order doesn't matter.

    The rule places sizes from large to small; then, in each round, it places
    anew the contents of all bins that are not full and of a random share of the
    others, and keeps that if it takes no more bins."""
    order = np.argsort(-sizes, kind="stable")
    own = sizes[order]
    where, rng = sum_of_squares(own, capacity), np.random.default_rng(0)
    for _ in range(rounds):
        filled = np.bincount(where, weights=own)
        again = (filled < capacity) | (rng.random(len(filled)) < share)
        moved = np.flatnonzero(again[where])
        if not again.any():
            break
        fresh = sum_of_squares(own[moved], capacity)
        if fresh.max() < again.sum():
            number = np.cumsum(~again) - 1
            where = number[where]
            where[moved] = fresh + int((~again).sum())
    by_bin = np.argsort(where, kind="stable")
    before = np.cumsum(own[by_bin]) - own[by_bin]
    first = np.r_[True, where[by_bin][1:] != where[by_bin][:-1]] if len(own) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(first, before, 0)) if len(own) else before
    bins, offsets = np.empty(len(own), np.int64), np.empty(len(own), np.int64)
    bins[order], offsets[order[by_bin]] = where, before - start
    return bins, offsets


def _pack_group(capacity: int, order: str | None = None):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["deal", "doc_id", "piece"], kind="stable", ignore_index=True)
        sizes = pdf["length"].to_numpy()
        where, offset = pack_sizes(sizes, capacity)
        if order is not None:
            mean = np.bincount(where, weights=sizes * pdf[order].to_numpy(float)) / np.bincount(where, weights=sizes)
            number = np.empty(len(mean), np.int64)
            number[np.argsort(mean, kind="stable")] = np.arange(len(mean))
            where = number[where]
        pdf["sequence_id"] = pdf["group"].to_numpy() * (1 << 32) + where
        pdf["offset"] = offset
        return pdf.drop(columns=["deal", "group"])

    return run


def pack(pieces: DataFrame, capacity: int = 1024, group_rows: int = 40_000, order: str | None = None) -> DataFrame:
    """Adds sequence_id and offset to pieces that have doc_id, piece and length.

    With order, the name of a column of whole numbers from 0 to 2^33, groups are
    contiguous ranges of it (null comes last), sequence_id grows from range to range,
    and within a range sequences are numbered by the mean order of their tokens.

    Every length must be from 1 to capacity. Pieces of one document need not land
    in one sequence. Repeated rows are packed each by itself; an empty table
    gives an empty result; further columns are carried along, save `group`, `deal` and
    `row`, which are reserved. pieces must be a stored table, whose rows stay in place."""
    groups = max(1, -(-pieces.count() // group_rows))
    # rows that share a document and piece are told apart by where they are stored
    dealt = pieces.withColumn("row", F.monotonically_increasing_id())
    dealt = dealt.withColumn("deal", F.xxhash64("doc_id", "piece", "row", F.lit(7)))
    if order is None:
        dealt = dealt.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece", "row"), F.lit(groups))).drop("row")
    else:
        # the hash divides a place that holds more rows than a group
        within = F.pmod(F.xxhash64("doc_id", "piece", "row"), F.lit(1 << 20))
        dealt = dealt.withColumn(order, F.coalesce(F.col(order).cast("long"), F.lit(1 << 33)))
        ranged = dealt.withColumn("group", F.col(order) * (1 << 20) + within).drop("row")
        dealt = chunk_of(ranged, "group", rows=group_rows).withColumn("group", F.col("chunk").cast("long")).drop("chunk")
    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")
    return dealt.groupBy("group").applyInPandas(_pack_group(capacity, order), schema)


def pack_documents(docs: DataFrame, capacity: int = 1024, end_id: int = 2, with_ids: bool = False, group_rows: int = 40_000, order: str | None = None) -> DataFrame:
    """Tokenizes, cuts and packs docs (doc_id, text), in ranges of order if it names
    a column (see pack), which is returned too.

    Null text is empty and gives one piece that holds the end token alone; a null
    doc_id stays null; rows that share a doc_id are packed each by itself. Other
    columns, whatever their names, are ignored."""
    modest_batches(docs.sparkSession)
    return pack(staged(tokenize_pieces(docs, capacity, end_id, with_ids=with_ids, order=order)), capacity, group_rows, order)
