"""Phrase collocations against plain counts, and the sort against a counter."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tessellate.llm import collocations as C

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, inside=80, top=2000):
    counts, sizes = {}, Counter()
    for text, lang in rows:
        own = counts.setdefault(lang if lang is not None else "und", Counter())
        for piece in re.split("[.,;:!?\\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = tuple(re.findall("[^ \t]+", piece))
            sizes[lang if lang is not None else "und"] += len(words)
            for n in range(1, 5):
                own.update(words[i : i + n] for i in range(len(words) - n + 1))
    out = []
    for lang, own in counts.items():
        found = {g: a for g, a in own.items() if len(g) > 1 and a >= least}
        kept = []
        for g, a in found.items():
            if any(len(h) > len(g) and 100 * b >= inside * a and any(h[i : i + len(g)] == g for i in range(len(h))) for h, b in found.items()):
                continue
            score, _, l, r = min((2000000 * a // (own[g[:k]] + own[g[k:]]), k, own[g[:k]], own[g[k:]]) for k in range(1, len(g)))
            kept.append((-score, -a, " ".join(g).encode(), l, r))
        for k, (score, a, g, l, r) in enumerate(sorted(kept)[:top]):
            out.append((lang, k + 1, g.decode(), -a, l, r, sizes[lang], -score))
    return sorted(out)


def got(df, **kw):
    return sorted(map(tuple, C.collocations(df, **kw).select(*COLUMNS).collect()))


def texts(n, seed=1):
    rng = np.random.default_rng(seed)
    words = ["The", "of", "a\u00e9", "x-1", "Ünï", "b", "c", "dd"]
    marks = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!", "\u00a0"]
    return [("".join(words[min(7, rng.zipf(1.6) - 1)] + marks[rng.integers(10)] for _ in range(rng.integers(0, 60))), ("en", "fr", None, "und")[rng.integers(4)]) for _ in range(n)]


@pytest.mark.parametrize("least", [2, 5])
def test_matches_plain(spark, least, monkeypatch):
    monkeypatch.setattr(C, "ROWS", 200)  # many ranges, so that phrases cross their ends
    rows = texts(300)
    df = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(rows)], "doc_id long, text string, lang string").repartition(5)
    want = plain(rows, least)
    assert len(want) > 100 and got(df, least=least) == want
    assert got(df, least=least, top=7, inside=60) == plain(rows, least, 60, 7)


def test_odd_rows(spark):
    rows = [(None, "en"), ("", None), ("  \t", "en"), ("one two", "en"), ("one two", "en"), ("one two", "en"), ("the same " * 30_000, "de"), (". " * 9, "fr"), ("x" * 50_000, "fr"), ("hot pair " * 40, None)]
    df = spark.createDataFrame(rows, "text string, lang string").select("*", *[F.lit(1).alias(c) for c in ("w", "f", "phrase", "a", "key", "value", "score", "rank")])
    assert got(df, least=3) == plain(rows, 3)
    assert got(df.limit(0)) == [] and C.collocations(df.limit(0)).columns == list(COLUMNS)


def test_quicksort_counts():
    rng = np.random.default_rng(3)
    rows = rng.zipf(1.3, (20_000, 4)).clip(0, 500).astype(np.int64)
    stop = rng.integers(2, 5, len(rows))
    for k in range(4):
        rows[stop <= k, k] = 0
    weights, want = rng.integers(1, 4, len(rows)), Counter()
    for r, n in zip(rows.tolist(), weights.tolist(), strict=True):
        for k in range(4):
            if r[k] == 0:
                break
            want[tuple(r[: k + 1])] += n
    for open_ends in (False, True):
        found, edges = {}, set()
        for length, pointers, counts, edge in C.quicksort_counts(rows, weights, 25, 1, open_ends):
            found |= {tuple(rows[p, :length].tolist()): int(c) for p, c in zip(pointers, counts, strict=True)}
            edges |= {tuple(rows[p, :length].tolist()) for p in pointers[edge]}
        ends = {tuple(sorted(map(tuple, rows.tolist()))[k][:n]) for k in (0, -1) for n in range(2, 5)} if open_ends else set()
        ends = {e for e in ends if 0 not in e}
        assert edges == ends
        assert found == {g: a for g, a in want.items() if len(g) > 1 and (a >= 25 or g in ends)}


def test_slices_keep_pieces():
    text = b"ab cd. " * 5 + b"x" * 40 + b"!" + b"yz " * 30
    cut = [t for _, t in C.slices([text, b""], size=10)]
    assert b"".join(cut) == text and cut[-1] == b""
    assert all(t[-1:] in b".,;:!?\n" for t in cut[:-3])


def test_colliding_hashes_are_told(spark, monkeypatch):
    """Two words of one hash make the table take the next seed."""
    plain_read, tried = C._word_counts, []

    def clash(seed):
        tried.append(seed)
        run = plain_read(seed)

        def same(batches):
            import pyarrow as pa

            for b in run(batches):
                yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(b), np.int64)), *b.columns[1:]], b.schema.names) if seed == 0 else b

        return same

    monkeypatch.setattr(C, "_word_counts", clash)
    words, seed = C.word_table(spark.createDataFrame([("a b a", "en")], "text string, lang string"))
    assert seed == 1 and tried == [0, 1]
    assert sorted((r["lang"], r["word"], r["f"]) for r in words.collect()) == [("en", "a", 2), ("en", "b", 1)]
