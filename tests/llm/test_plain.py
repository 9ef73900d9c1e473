"""Mixing, fingerprints and languages, each worked out again in plain code."""

import math
import re
import struct
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
import xxhash
from tessellate.llm.language import LONGEST, identify_language
from tessellate.llm.mixing import mix
from tessellate.llm.order_minhash import fingerprints

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def interleaved(sizes, shares, period):
    """Of the number of blocks of each source: the slot and place of each block, and the
    first slot that is empty, by a plain run of earliest deadline first."""
    order = sorted(shares, key=lambda s: (s is not None, s or ""))
    weight = {s: Fraction(n, period) for s, n in shares.items()}
    had, slots, horizon, t = dict.fromkeys(order, 0), {}, None, 0
    while horizon is None or any(had[s] < sizes.get(s, 0) for s in order):
        ready = [s for s in order if math.floor(had[s] / weight[s]) <= t]
        s = min(ready, key=lambda s: (math.ceil((had[s] + 1) / weight[s]), -shares[s], order.index(s)))
        if had[s] < sizes.get(s, 0):
            slots[s, had[s]] = t, len(slots)
        elif horizon is None:
            horizon = t
        had[s] += 1
        t += 1
    return slots, horizon


def test_places_and_targets_are_those_of_a_plain_schedule(spark):
    rows, at = [], 0
    for source, n, size in (("a", 60, 37), ("b", 25, 110), ("c", 9, 700), (None, 12, 55), ("unnamed", 4, 50)):
        for _ in range(n):
            rows.append((at, "x" * size, source))
            at += 7
    shares = {"a": 9, "b": 5, "c": 3, None: 2, "absent": 1}
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    before, blocks = Counter(), {}
    for i, text, source in rows:
        blocks[i] = before[source] // 100
        before[source] += len(text)
    counts = defaultdict(int)
    for i, _, source in rows:
        counts[source] = max(counts[source], blocks[i] + 1)
    for named in (shares, {s: n for s, n in shares.items() if s != "absent"} | {"a": 10}):
        weights = spark.createDataFrame(list(named.items()), "source string, share int")
        slots, horizon = interleaved(counts, named, 20)
        got = mix(df, weights, period=20, block_chars=100).collect()
        assert sorted(r["doc_id"] for r in got) == [i for i, _, _ in rows]
        for r in got:
            assert r["block"] == blocks[r["doc_id"]]
            slot, place = slots.get((r["source"], r["block"]), (None, None))
            assert (r["slot"], r["place"]) == (slot, place)
            assert r["on_target"] == (slot is not None and slot < horizon)


def spark_hash(x, seed=42):
    """xxhash64 of a value after those that the seed stands for; unsigned."""
    data = x.encode() if isinstance(x, str) else struct.pack(*x)
    return xxhash.xxh64_intdigest(data, seed)


def signature(text, k=3, bins=32, keep=2):
    """The k-mers numbered, dealt over the bins by their highest bits, the least of
    each put back into the order of the text."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    hashes = [spark_hash(w) for w in words]
    seen, chosen = Counter(), defaultdict(list)
    for i in range(max(len(words) - k + 1, min(len(words), 1))):
        h = 42
        for x in hashes[i : i + k]:
            h = spark_hash(("<Q", x), h)
        h >>= 30
        u = spark_hash(("<i", seen[h]), spark_hash(("<q", h)))
        seen[h] += 1
        chosen[u * bins >> 64].append((u >> 30, i))
    out = {}
    for b, found in chosen.items():
        h = 42
        for u, _ in sorted(sorted(found)[:keep], key=lambda x: x[1]):
            h = spark_hash(("<Q", u % (1 << 33)), h)
        out[b] = (b << 59) | (h >> 5)
    return out


def printed(signed):
    return "".join(f"{signed[b]:016x}" for b in sorted(signed, key=lambda b: (b < 16, b)))


def alike(a, b):
    filled = set(a) | set(b)
    return sum(a.get(x) == b.get(x) for x in filled) / len(filled) if filled else 1.0


def test_signatures_and_likeness_match_plain(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    odd = [(1, "a a a a a a b a a a"), (2, None), (3, ""), (4, "one"), (5, "\t x y \n"), (6, "v w " * 30_000 + "end"), (7, "ünï çödé " * 9), (8, "a a a a a a b a a a")]
    for table in (rows, odd, odd[:1]):
        df = spark.createDataFrame(table, "doc_id long, text string").repartition(3)
        got = {r["doc_id"]: r for r in fingerprints(df).collect()}
        table = sorted((i, t or "") for i, t in table)
        for (i, text), (_, after) in zip(table, table[1:] + table[:1], strict=True):
            cut = len(text) // 4
            own, edited, following = map(signature, (text, text[: len(text) - cut] + after[:cut], after))
            assert got[i]["fingerprint"] == printed(own)
            assert got[i]["edited_fingerprint"] == printed(edited)
            assert got[i]["near_edited"] == pytest.approx(alike(own, edited))
            assert got[i]["near_next"] == pytest.approx(alike(own, following))


def grams_of(word, n):
    w = f"<{word}>"
    return [w[i : i + n] for i in range(len(w) - n + 1)]


def test_languages_match_plain_scores(spark, docs):
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    rows += [(10**9 + k, t, None) for k, t in enumerate(("unforeseeably thinglike", "Straßenschildchen überqueren", "qqq zzz", "12 34", None, "日本語", "the und " * 20_000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    words, grams = defaultdict(Counter), defaultdict(Counter)
    read = lambda t: re.findall(r"[^\W\d_]+", (t or "").lower())
    for i, text, lang in rows:
        if zlib.crc32(str(i).encode()) % 5 and lang is not None:
            words[lang].update(read(text))
    languages = sorted(words)
    for lang in languages:
        for w, n in words[lang].items():
            for size in range(1, LONGEST + 1):
                for g in grams_of(w, size):
                    grams[lang][g] += n

    def logs(counts):
        known = set().union(*counts.values())
        total = {x: sum(counts[x].values()) + 0.5 * len(known) for x in languages}
        return {t: [math.log((counts[x][t] + 0.5) / total[x]) for x in languages] for t in known}

    by_word, by_gram = logs(words), logs(grams)

    def score(w):
        if w in by_word:
            return by_word[w]
        for size in range(min(LONGEST, len(w) + 2), 0, -1):
            known = [by_gram[g] for g in grams_of(w, size) if g in by_gram]
            if known:
                return [sum(x) / len(known) for x in zip(*known, strict=True)]
        return [0.0] * len(languages)

    got = {r["doc_id"]: r for r in identify_language(docs).collect()}
    backed = 0
    for i, text, _ in rows:
        found = read(text)
        if not found:
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
            continue
        backed += any(w not in by_word for w in found)
        total = [sum(x) for x in zip(*map(score, found), strict=True)]
        best = max(total)
        assert got[i]["lang_pred"] == languages[total.index(best)]
        assert got[i]["score"] == pytest.approx(1 / sum(math.exp(max(x - best, -700)) for x in total), abs=1e-9)
    assert len(languages) > 1 and backed
