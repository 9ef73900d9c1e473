"""Encoding to the ids of a SentencePiece BPE vocabulary, and decoding, in numpy.

The library keeps a queue of adjacent pairs for each text and merges the best one at a
time. Here all words of a batch lie in one flat array of symbols. Each round looks up
the rank of every adjacent pair, takes the least rank of each word (a segmented
minimum), merges the leftmost pairs of that rank of all words at once, and compacts the
array; words without a pair that merges leave it. A word is a stretch that no merge can
cross: it is cut wherever two characters stand together in no piece of the vocabulary,
which no merge could join.

Merges of one round are those that the queue would make one after another: a word stops
at the first merge after which a pair of the same or a better rank stands at its place.
Long words of pairs that are all of one rank, such as runs of spaces, then merge once a
round; what is left of a word after ROUNDS rounds is merged by a queue, as the library does.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import modest_batches

SPACE = "▁"
#: How many words a task remembers with their ids, and the longest word remembered.
REMEMBERED, SHORT = 1 << 19, 48
#: Words that still merge after so many rounds are finished by a queue.
ROUNDS = 64
#: A space, and what it begins: further spaces and a word.
RUNS = re.compile(" ( *[^ ]+| *)")
NEVER = np.int64(1 << 40)


def _bounds(word: np.ndarray) -> tuple[list[int], list[int]]:
    """Where each run of equal numbers begins and ends."""
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else np.zeros(0, np.int64)
    return first.tolist(), np.append(first[1:], len(word)).tolist() if len(first) else []


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, otherwise: int) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), otherwise, np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], otherwise)


class PieceCodec:
    """The vocabulary of a model file: its pieces, the pairs that merge and their
    ranks, and the pairs of characters that some piece holds.

    The model must be BPE with byte fallback, an identity normalizer, a dummy prefix,
    and no pieces that are unused or defined by a user; others are refused."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = self.size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        is_byte = np.array([model.is_byte(i) for i in range(size)])
        special = np.array([model.is_control(i) or model.is_unknown(i) for i in range(size)])
        probe = "A  b\tﬁ Ⅷ"
        if is_byte.sum() != 256 or any(model.is_unused(i) for i in range(size)) or model.decode(model.encode(probe)) != probe or model.id_to_piece(model.encode("A")[0])[0] != SPACE:
            raise ValueError("the model must be BPE with byte fallback, identity normalizer and dummy prefix")
        ids = {p: i for i, p in enumerate(names) if not is_byte[i] and not special[i]}
        #: A symbol is a piece's id, or beyond these, a character that is no piece.
        symbols = dict(ids)
        for p in ids:
            for c in p:
                symbols.setdefault(c, len(symbols) + size)
        by_score = sorted({model.get_score(i) for i in ids.values()}, reverse=True)
        rank_of = {s: r for r, s in enumerate(by_score)}
        self.width = max(symbols.values()) + 1
        merges: dict[int, int] = {}
        joined: set[tuple[str, str]] = set()
        for p, i in ids.items():
            joined.update(zip(p, p[1:], strict=False))
            for k in range(1, len(p)):
                a, b = symbols.get(p[:k]), symbols.get(p[k:])
                if a is not None and b is not None:
                    merges[a * self.width + b] = i
        self.pairs = np.array(sorted(merges), np.int64)
        self.merged = np.array([merges[int(k)] for k in self.pairs], np.int64)
        ranks = np.full(size, NEVER)
        for i in ids.values():
            ranks[i] = rank_of[model.get_score(i)]
        self.pair_ranks = ranks[self.merged] if len(self.merged) else np.zeros(0, np.int64)
        # characters: their symbols, and a small number for those that stand beside others
        self.symbol_of = np.full(0x110000, -1, np.int32)
        for s, i in symbols.items():
            if len(s) == 1:
                self.symbol_of[ord(s)] = i
        beside = sorted({c for pair in joined for c in pair})
        self.number = np.zeros(0x110000, np.int32)
        for n, c in enumerate(beside):
            self.number[ord(c)] = n + 1
        place = {c: n + 1 for n, c in enumerate(beside)}
        self.beside = np.zeros((len(beside) + 1, len(beside) + 1), bool)
        for a, b in joined:
            self.beside[place[a], place[b]] = True
        self.byte_id = np.zeros(256, np.int64)
        for i in np.flatnonzero(is_byte):
            self.byte_id[int(names[i][1:-1], 16)] = i
        #: Whether a space can only begin a word, so that texts may be cut there first.
        self.cut_at_spaces = not any(b == SPACE and a != SPACE for a, b in joined)
        # for decoding
        self.is_byte = is_byte
        unknown = model.decode([model.unk_id()])
        spelled = [bytes([int(p[1:-1], 16)]) if is_byte[i] else b"" if model.is_control(i) else unknown.encode() if special[i] else p.replace(SPACE, " ").encode() for i, p in enumerate(names)]
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.lengths = np.array([len(s) for s in spelled], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.first_space = np.array([p.startswith(SPACE) and not is_byte[i] for i, p in enumerate(names)])

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        ok = (left >= 0) & (right >= 0)
        out = np.full(len(left), NEVER)
        out[ok] = _lookup(self.pairs, self.pair_ranks, left[ok].astype(np.int64) * self.width + right[ok], int(NEVER))
        return out

    def merge_rounds(self, symbols: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols left when no pair of any word merges, and their places. words
        numbers the word of each symbol, ascending; a negative symbol never merges."""
        place = np.arange(len(symbols))
        done_symbols, done_places = [], []
        sym, word = symbols.astype(np.int64), words
        rank = np.full(len(sym), NEVER)
        inner = np.flatnonzero(word[:-1] == word[1:])
        rank[inner] = self._rank(sym[inner], sym[inner + 1])
        for _ in range(ROUNDS):
            if not len(sym):
                break
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            length = np.diff(np.append(first, len(sym)))
            least = np.repeat(np.minimum.reduceat(rank, first), length)
            if (over := least == NEVER).any():
                done_symbols.append(sym[over])
                done_places.append(place[over])
                sym, word, rank, place, least = (x[~over] for x in (sym, word, rank, place, least))
                if not len(sym):
                    break
            # of overlapping pairs every other one, from the left
            hit = np.flatnonzero(rank == least)
            run = np.concatenate([[True], np.diff(hit) != 1])
            hit = hit[(np.arange(len(hit)) - np.flatnonzero(run)[np.cumsum(run) - 1]) % 2 == 0]
            made = _lookup(self.pairs, self.merged, sym[hit] * self.width + sym[hit + 1], -1)
            # the neighbours at the time of each merge: on the left what was merged before
            before, after = hit - 1, hit + 2
            has_left = (before >= 0) & (word[before] == word[hit])
            left = np.where(has_left, sym[before], -1)
            follows = np.flatnonzero(np.diff(hit) == 2) + 1
            left[follows] = np.where(has_left[follows], made[follows - 1], -1)
            has_right = after < len(sym)
            after = np.minimum(after, len(sym) - 1)
            has_right &= word[after] == word[hit]
            right = np.where(has_right, sym[after], -1)
            stops = (self._rank(left, made) <= least[hit]) | (self._rank(made, right) <= least[hit])
            if stops.any():
                begins = np.concatenate([[True], word[hit][1:] != word[hit][:-1]])
                earlier = np.cumsum(stops) - stops
                keep = earlier == earlier[np.flatnonzero(begins)][np.cumsum(begins) - 1]
                hit, made = hit[keep], made[keep]
            sym = sym.copy()
            sym[hit] = made
            left_on = np.ones(len(sym), bool)
            left_on[hit + 1] = False
            fresh = np.zeros(len(sym), bool)
            fresh[hit] = True
            sym, word, rank, place, fresh = (x[left_on] for x in (sym, word, rank, place, fresh))
            new = np.flatnonzero(fresh)
            fresh[new[new > 0] - 1] = True
            touched = np.flatnonzero(fresh)
            last = touched == len(sym) - 1
            rank[touched[last]] = NEVER
            touched = touched[~last]
            same = word[touched] == word[touched + 1]
            rank[touched] = NEVER
            rank[touched[same]] = self._rank(sym[touched[same]], sym[touched[same] + 1])
        for lo, hi in zip(*_bounds(word), strict=True):
            left, at = self._queued(sym[lo:hi].tolist(), place[lo:hi])
            done_symbols.append(left)
            done_places.append(at)
        if not done_symbols:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.concatenate(done_places)
        order = np.argsort(at, kind="stable")
        return np.concatenate(done_symbols)[order], at[order]

    def _queued(self, sym: list[int], place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As merge_rounds, of one word, by a queue of its pairs."""
        n = len(sym)
        after, before = list(range(1, n)) + [-1], list(range(-1, n - 1))
        ranks = dict(zip(self.pairs.tolist(), zip(self.pair_ranks.tolist(), self.merged.tolist(), strict=True), strict=True))
        queue: list[tuple[int, int, int, int]] = []

        def add(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and sym[i] >= 0 and sym[j] >= 0 and (found := ranks.get(sym[i] * self.width + sym[j])):
                heapq.heappush(queue, (found[0], i, sym[i], sym[j]))

        for i in range(n - 1):
            add(i, i + 1)
        alive = [True] * n
        while queue:
            _, i, a, b = heapq.heappop(queue)
            j = after[i]
            if not alive[i] or j < 0 or sym[i] != a or sym[j] != b:
                continue
            sym[i] = ranks[a * self.width + b][1]
            alive[j] = False
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            add(before[i], i)
            add(i, after[i])
        on = np.flatnonzero(alive)
        return np.array(sym, np.int64)[on], place[on]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """For each string, in which spaces are SPACE already, the ids of its pieces
        as little-endian unsigned 32-bit numbers."""
        if not words:
            return []
        lengths = np.array([len(w) for w in words], np.int64)
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        owner = np.repeat(np.arange(len(words)), lengths)
        small = self.number[flat]
        cut = np.ones(len(flat), bool)
        cut[1:] = ~self.beside[small[:-1], small[1:]] | (owner[1:] != owner[:-1])
        symbols, places = self.merge_rounds(self.symbol_of[flat].astype(np.int64), np.cumsum(cut))
        # characters that are no piece: their bytes
        unknown = (symbols < 0) | (symbols >= self.size)
        ids, of = symbols, owner[places]
        if unknown.any():
            spelled = [chr(c).encode("utf-8", "surrogatepass") for c in flat[places[unknown]]]
            count = np.ones(len(symbols), np.int64)
            count[unknown] = [len(s) for s in spelled]
            ids, of = np.repeat(symbols, count), np.repeat(of, count)
            ids[np.repeat(unknown, count)] = self.byte_id[np.frombuffer(b"".join(spelled), np.uint8)]
        data = ids.astype("<u4").tobytes()
        ends = 4 * np.searchsorted(of, np.arange(len(words)), side="right")
        starts = np.concatenate([[0], ends[:-1]]).tolist()
        return [data[a:b] for a, b in zip(starts, ends.tolist(), strict=True)]

    def encode_batch(self, texts: list[str], known: dict[str, bytes]) -> list[bytes]:
        """The ids of each text. known holds those of short words met before; it is
        added to, and emptied when it has grown to REMEMBERED words."""
        # a word goes by what follows the space before it
        split: list[list[str]] = []
        for t in texts:
            t = t.replace(SPACE, " ")  # the two are one to the vocabulary
            if not t:
                split.append([])
            elif not self.cut_at_spaces:
                split.append([t.replace(" ", SPACE)])
            elif "  " not in t and t[0] != " ":
                split.append(t.split(" "))
            else:
                split.append([w.replace(" ", SPACE) for w in RUNS.findall(" " + t)])
        if len(known) > REMEMBERED:
            known.clear()
        fresh = [w for w in {w for words in split for w in words} if w not in known]
        known.update(zip(fresh, self.encode_words([SPACE + w for w in fresh]), strict=True))
        out = [b"".join([known[w] for w in words]) for words in split]
        for w in fresh:
            if len(w) > SHORT:
                del known[w]
        return out

    def decode_batch(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of ids that lie one after another, up to each of ends. A leading
        space goes; bytes that are no UTF-8 become U+FFFD one by one."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.size):
            raise ValueError("an id is out of range")
        lengths = self.lengths[ids]
        stops = np.cumsum(lengths)
        inside = np.arange(int(stops[-1]) if len(stops) else 0) - np.repeat(stops - lengths, lengths)
        data = self.spelled[np.repeat(self.starts[ids], lengths) + inside].tobytes()
        out, a = [], 0
        bounds = np.concatenate([[0], stops])
        for lo, hi in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            b = int(bounds[hi])
            own = data[a:b]
            while lo < hi and not self.lengths[ids[lo]]:
                lo += 1
            if lo < hi and self.first_space[ids[lo]]:
                own = own[1:]
            try:
                out.append(own.decode())
            except UnicodeDecodeError:
                out.append(_bytewise(own))
            a = b
        return out


def _bytewise(data: bytes) -> str:
    """data as text; each byte that begins no character is U+FFFD."""
    out, at = [], 0
    while at < len(data):
        for n in (1, 2, 3, 4):
            try:
                out.append(data[at : at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


@lru_cache(maxsize=2)
def codec(model: str) -> PieceCodec:
    """The codec of a model of public_tokenizers, or of a path, once for each worker."""
    import public_tokenizers

    return PieceCodec(model if "/" in model else public_tokenizers.path(model))


def _coded(model: str, size: int, remembered: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for b in batches:
            column, at = b.column(1), 0
            while at < len(b):
                # rows by their bytes, so that memory doesn't depend on the batch
                texts, total, lo = [], 0, at
                while at < len(b) and (total < size or at == lo):
                    t = column[at].as_py() or ""
                    texts.append(t)
                    total += len(t)
                    at += 1
                spelled = own.encode_batch(texts, remembered)
                ids = np.frombuffer(b"".join(spelled), "<u4").astype(np.int32)
                ends = np.cumsum([len(s) // 4 for s in spelled])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids))
                decoded = pa.array(own.decode_batch(ids, ends), pa.string())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, at - lo), lists, decoded], ["doc_id", "ids", "decoded"])

    return run


def encode_pieces(docs: DataFrame, model: str = "piece_bpe_32k.model", size: int = 1 << 21) -> DataFrame:
    """A row for each row of docs (doc_id, text): doc_id, ids (array<int>, as the
    sentencepiece library encodes the text without begin or end ids) and decoded (the
    ids decoded again).

    model is a file of public_tokenizers or a path that all executors have. A null or
    empty text has no ids and decodes to an empty one. Rows are independent: repeated
    rows, null ids and other columns, whatever their names, change nothing. Texts are
    encoded whole; a task remembers short words between batches, and forgets all of
    them when they are more than REMEMBERED."""
    modest_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_coded(model, size, {}), "doc_id long, ids array<int>, decoded string")


def digests(coded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids, joined by commas) and
    decoded_sha256 of what encode_pieces returns."""
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
